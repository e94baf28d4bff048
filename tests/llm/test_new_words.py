from mergeloom.llm.encoding import Encoder, tokenizer_path

from test_tokens import reference


class Counted:
    def __init__(self, inner):
        self.inner, self.calls = inner, 0

    def encode_ordinary(self, text):
        self.calls += 1
        return self.inner.encode_ordinary(text)


def test_new_words_of_a_text_are_encoded_together(monkeypatch):
    from mergeloom.llm import encoding

    monkeypatch.setattr(encoding, "WORDS_AT_ONCE", 300)
    monkeypatch.setattr(encoding, "KEPT_WORDS", 700)
    encoder = Encoder(tokenizer_path())
    encoder.fast = Counted(encoder.fast)
    tails = ["", ",", ".\n", "\n\n", "ß", "'s", "\t", "日", "\x1c", "¡"]
    text = "first" + "".join(f" qx{i * 7919}{tails[i % 10]}" for i in range(1000))
    assert encoder.encode(text).tolist() == reference(text)
    assert encoder.fast.calls < 100 and len(encoder.words) <= 700

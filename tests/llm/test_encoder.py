"""Pre-tokens that are remembered, and the ids of many at once."""

from motionframe.llm import packing, pretokens
from motionframe.llm.queries_rows import vocabulary


def test_a_full_memory_of_pre_tokens_keeps_those_that_are_met(monkeypatch):
    """A pre-token of every batch is encoded once, though new ones fill the memory again and again; ids are those of each word alone."""
    monkeypatch.setattr(pretokens, "REMEMBERED", 40)
    asked = []
    encoder = pretokens.Encoder(lambda words: asked.extend(words) or [[len(w), ord(w[-1])] for w in words])
    for k in range(30):
        assert encoder.batch([f"the w{chr(97 + k % 26)}{'x' * k} the"])[0].reshape(-1, 2).tolist() == [[3, ord("e")], [k + 3, ord("x" if k else "a")], [4, ord("e")]]
        assert len(encoder.known) <= 40 and len(encoder.older) <= 40
    assert asked.count("the") == asked.count(" the") == 1


def test_words_encoded_at_once_have_their_own_ids():
    path = vocabulary("byte_bpe_50k.json")
    tokenizer, _, _ = packing._tokenizer(path)
    words = [" the", "'s", "\n", "  ", " ", "Zürich", " 12345", "!?", "中文", " \U0001f600", "a" * 300, "\t\n "]
    assert [x.tolist() for x in packing._ids_of_words(tokenizer, words)] == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert packing._ids_of_words(tokenizer, words[:1])[0].tolist() == tokenizer.encode(" the", add_special_tokens=False).ids

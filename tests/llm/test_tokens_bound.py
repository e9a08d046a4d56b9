"""The words that a worker keeps are bounded, whatever it reads, and the ids do not depend on it."""

from tokenizers import Tokenizer

from matchlake.llm import tokens


def test_a_worker_keeps_a_bounded_number_of_words(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 100)
    path = tokens.vocabulary_path()
    ids, kept = tokens.WordIds(path, "I"), []
    monkeypatch.setattr(ids, "seen", {})
    plain = Tokenizer.from_file(path)
    for i in range(40):
        text = " ".join(f"w{chr(97 + j % 26)}{chr(97 + i % 26)}ord{j}, and" for j in range(20 * i, 20 * i + 20))
        assert ids.raw(text) == b"".join(n.to_bytes(4, "little") for n in plain.encode(text, add_special_tokens=False).ids)
        kept.append(len(ids.seen))
    assert max(kept) < 300


def test_a_word_of_marks_that_was_seen_is_no_core(monkeypatch):
    path = tokens.vocabulary_path()
    ids = tokens.WordIds(path, "I")
    monkeypatch.setattr(ids, "seen", {})
    plain = Tokenizer.from_file(path)
    for text in ("<", "<:", "s<", "s<:", "é9", "é9,"):
        want = plain.encode(text, add_special_tokens=False).ids
        assert ids.raw(text) == b"".join(n.to_bytes(4, "little") for n in want)

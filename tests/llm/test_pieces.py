"""What the piece scan costs per character."""

import public_tokenizers

from attesta.llm import pieces


class Cut(str):
    """A text that counts the pieces cut from it."""

    count = 0

    def __getitem__(self, at):
        if isinstance(at, slice):
            Cut.count += 1
        return str.__getitem__(self, at)


def plain(mine, s):
    """Best score and last piece's start of every position, from every piece of the vocabulary."""
    best, back = [0.0] + [pieces.NONE] * len(s), [-1] * (len(s) + 1)
    for e in range(1, len(s) + 1):
        for i in range(max(0, e - mine.longest), e):
            score = mine.by_text[s[i:e]][1] if s[i:e] in mine.by_text else mine.unknown_score if e == i + 1 else pieces.NONE
            if best[i] + score > best[e]:
                best[e], back[e] = best[i] + score, i
    return best, back


def test_a_position_of_a_new_word_cuts_the_text_once():
    mine = pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    for text in ("▁undertakings", "▁zzqxj", "internationalisation", "▁naïveté▁ᚠ漢字\x00x", "e" * 40, "▁" * 20):
        Cut.count = 0
        found = mine.forward(Cut(text), [0.0], len(text))
        assert Cut.count <= len(text)
        assert found == plain(mine, text)
        assert mine.decode(mine.trace(text, found[1], len(text))[0]) == text.replace("▁", " ")[1:]


def test_the_tree_holds_every_piece_and_no_other():
    root = pieces.tree({"ab": -1.0, "abc": -2.0, "b": -3.0})
    assert root["a"][1] is None and root["a"][0]["b"][1] == -1.0 and root["a"][0]["b"][0]["c"] == ({}, -2.0) and root["b"] == ({}, -3.0)
    assert root["b"][0] is root["a"][0]["b"][0]["c"][0]

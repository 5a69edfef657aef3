"""Token alignment against both libraries on whole texts."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from attesta.llm import alignment
from attesta.llm.common import QUERIES, ready
from attesta.llm.tokenids import _byte_marks

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


@pytest.fixture(scope="module")
def whole():
    """The groups of a whole text: lists of A ids and B ids, and the byte where each ends."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    marks = {mark: byte for byte, mark in _byte_marks().items()}

    def run(text):
        if not text:
            return []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(marks[ch] for ch in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return []
        ends = lambda parts: [sum(map(len, parts[: k + 1])) for k in range(len(parts))] if len(parts) < 3000 else running(parts)
        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, before = [], 0
        at_a = {e: k for k, e in enumerate(ends_a)}
        at_b = {e: k for k, e in enumerate(ends_b)}
        x = y = 0
        for cut in cuts:
            groups.append((ids_a[x : at_a[cut] + 1], ids_b[y : at_b[cut] + 1], cut - before))
            x, y, before = at_a[cut] + 1, at_b[cut] + 1, cut
        return groups

    def running(parts):
        out, n = [], 0
        for p in parts:
            n += len(p)
            out.append(n)
        return out

    return run


def expected(rows, whole):
    found = [(i, whole(t)) for i, t in rows]
    counts = Counter((a[-1], b[-1]) for _, groups in found for a, b, _ in groups)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    out = []
    for i, groups in found:
        pairs = [(a[-1], b[-1]) for a, b, _ in groups]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b, _ in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(pairs), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs), sha))
    return sorted(out, key=str)


ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  ", "a  b", "a \n b", "a\n b", "a\nb\n\n c", "\ta\t b", "don't it's we'll I'M", "x" * 3000, "12345 6 7890", "漢字 漢", "😀😀 é😀a", "héllo wörld ñandú", "\x00 \x1c x\x1f y\x85 z", "a▁b", "▁", "_▁ ok",
    "<s> </s> <unk> <0x0A> <|endoftext|>", "<|endoftext|>", "a b  c", "ﬁ ① Å Å", "é ​ x", "mixed 漢 kana かな and 😀 emoji 👩‍👩‍👧 end", "tab\tsep  two   three    four", "trail \n", "… — “q”", "\r\n x\r\n\r\ny",
]


def make(session, rows):
    return session.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, block int, links string")


def run(docs, monkeypatch=None):
    aligned = alignment.align(docs, A, B)
    from pyspark.sql import functions as F

    facts = aligned.select("id", "n_a", "n_b", F.size("sizes").cast("long").alias("n_groups"), F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("").alias("sha"), "links")
    found = alignment.link_counts(facts, ["id", "n_a", "n_b", "n_groups", "sha"]).select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha")
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize(("window", "known"), [(1 << 20, 100_000), (5, 20), (20, 1)])
def test_parts_against_whole_texts(whole, monkeypatch, window, known):
    monkeypatch.setattr(alignment, "WINDOW", window)
    monkeypatch.setattr(alignment, "KNOWN", known)
    aligner = alignment.Aligner(A, B)
    rng = random.Random(3)
    alphabet = list("abcDEF'.,-19 \n\t  ") + ["漢", "é", "😀", " the", " it's", " ", "▁", "\x00", "́"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    found = aligner.texts(texts[:300]) + [aligner.texts([t])[0] for t in texts[300:600]] + aligner.texts(["", " ".join(t for t in texts[:50] if t), *texts[600:]])
    for t, (n_a, n_b, groups, sizes, links) in zip([*texts[:600], "", " ".join(t for t in texts[:50] if t), *texts[600:]], found, strict=True):
        want = whole(t)
        assert groups == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b, _ in want), repr(t)
        assert list(sizes) == [s for _, _, s in want]
        assert list(links) == [a[-1] << 32 | b[-1] for a, b, _ in want]
        assert (n_a, n_b) == (sum(len(a) for a, _, _ in want), sum(len(b) for _, b, _ in want))


@pytest.mark.parametrize("block", [3, 1 << 22])
def test_odd_rows_in_blocks(session, whole, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    rows = list(enumerate(ODD)) + [(None, "no id here"), (3, "a b a b"), (3, "a b a b"), (900, " ".join(["the long text"] * 4000))]
    assert run(make(session, rows)) == expected(rows, whole)


def test_empty_table(session):
    assert run(make(session, [])) == []


def test_query_over_whole_documents(session, whole):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in session.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_token_alignment"](session, folder)
    assert got.columns == NAMES
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows, whole)


def test_texts_meet_one_python_worker_before_their_blocks(session):
    """Groups and links, several times the texts, do not go through the JVM from one worker to another."""
    docs = make(session, list(enumerate(ODD)))
    facts, kinds = ["id", "n_a"], "id long, n_a long"
    gather = alignment.gathered(facts)

    def chosen(batches):
        for b in batches:
            yield b.select(["id", "n_a", "links"])

    blocks = alignment.align(docs, A, B, then=lambda batches: gather(chosen(batches)), schema=alignment.block_schema(kinds))
    assert blocks._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    want = alignment.link_counts(alignment.align(docs, A, B), facts).collect()
    assert sorted(map(tuple, alignment.block_counts(blocks, facts).collect())) == sorted(map(tuple, want))

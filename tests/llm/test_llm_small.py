"""Awkward rows for every operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import licences, minhash, mixing, pieces, pii, quality, spotsigs, tokenids, urlfilter, warc
from attesta.llm.common import QUERIES, ready

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


def vocabulary(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def docs_of(session, rows):
    return session.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


WORDS = [a + b for a in ("tion", "the", "er", "an", "ing") for b in ("", "la", "st", "ou", "re")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(4)
    long = prose(rng, 30_000)
    return [
        (1, None, "a"), (2, "", "a"), (3, "   \n\t ", None), (4, "one", "b"), (5, "one", "b"), (6, "One two", "b"), (7, long, "c"), (8, long, "c"), (9, "é ß 漢字 ☃ 😀 \x00", None),
        (10, "x" * 5000, "é"), (None, "a row without an id", "a"), (11, prose(rng, 80), "a"), (11, prose(rng, 80), "a"), (12, "mail a.b@c.de now", "a"),
    ]


def texts_of(rows):
    return sorted(((i, t) for i, t, _ in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def empty(session):
    return session.createDataFrame([], DOCS)


def clashing(session, rows, names):
    """The rows with further columns that carry the operator's own names."""
    df = docs_of(session, rows)
    for name in names:
        if name.lower() not in {c.lower() for c in df.columns}:
            df = df.withColumn(name, F.lit("clash"))
    return df


# Mixing


def test_mixing_odd_rows(session, odd_rows):
    df = clashing(session, odd_rows, ["size", "target", "taken", "copies", "position", "epoch", "_row", "_key"])
    got = mixing.allocate(df).select("_row.*", F.col("_key").alias("k"), F.col("size").alias("z"), F.col("target").alias("g"), F.col("taken").alias("w"), F.col("source_size").alias("ss"), F.col("_row.source").alias("src")).collect()
    assert len(got) == len(odd_rows)
    by_source = {}
    for r in got:
        assert r.z == len(SPACE.findall(r.text or "")) and 0 <= r.w <= 2 * r.z and r.g <= 2 * r.ss + 1e-6
        by_source.setdefault(r.src, []).append(r)
    for rows in by_source.values():
        assert abs(sum(r.w for r in rows) - rows[0].g) <= 1
    assert mixing.allocate(empty(session)).collect() == []
    assert mixing.training_order(empty(session)).collect() == []


def test_mixing_source_without_words(session, odd_rows, tmp_path):
    bare = [(70, None, "bare"), (71, "", "bare"), (72, " \n", "bare"), (73, None, "z")]
    for rows in ([*odd_rows, *bare], bare):
        df = docs_of(session, rows)
        for whole in (False, True):
            got = mixing.allocate(df, whole=whole).select("_key", "source", "size", "target", "taken", "copies").collect()
            assert len(got) == len(rows) and sum(r.taken for r in got) == sum(c.words for r in got for c in r.copies)
            assert [(r.size, r.target, r.taken, r.copies) for r in got if r.source in ("bare", "z")] == [(0, 0.0, 0, [])] * 4
            assert {r._key for r in got if r.taken} <= {i for i, t, _ in rows if SPACE.search(t or "")}
        assert {r.source for r in mixing.training_order(df).collect()} == {s for _, t, s in rows if SPACE.search(t or "")}
        df.write.parquet(f"{tmp_path}/{len(rows)}/documents.parquet")
        told = QUERIES["op1_mix_sources"](session, f"{tmp_path}/{len(rows)}").collect()
        assert sorted(str(r.doc_id) for r in told) == sorted(str(i) for i, _, _ in rows) and all((r.first_position is None) == (r.taken == 0) for r in told)


def test_mixing_targets_by_hand(session):
    # Weights 5, 2, 1: shares of 1.5 * 1000 are 937.5, 375, 187.5; a stops at 200, what it leaves goes 2:1 to b and c.
    totals = session.createDataFrame([("a", 100, 1), ("b", 400, 1), ("c", 500, 1)], "source string, source_size long, n_rows long")
    got = {r.source: r.target for r in mixing.targets(totals).collect()}
    assert got["a"] == 200 and got["b"] == pytest.approx(800) and got["c"] == pytest.approx(500)


def test_mixing_targets_against_rounds(session):
    rng = random.Random(2)
    for _ in range(3):
        sizes = {f"s{k:02}": rng.randint(1, 1000) for k in range(11)}
        names = sorted(sizes)
        weight = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}
        open_, target, left = set(names), {}, 1.5 * sum(sizes.values())
        while open_:
            w = sum(weight[n] for n in open_)
            full = {n for n in open_ if left * weight[n] / w > 2 * sizes[n]}
            if not full:
                target |= {n: left * weight[n] / w for n in open_}
                break
            target |= {n: 2.0 * sizes[n] for n in full}
            left -= sum(2.0 * sizes[n] for n in full)
            open_ -= full
        totals = session.createDataFrame([(n, sizes[n], 1) for n in names], "source string, source_size long, n_rows long")
        got = {r.source: r.target for r in mixing.targets(totals).collect()}
        assert got == pytest.approx(target)


def test_mixing_order_inverts_the_schedule(session):
    rng = random.Random(3)
    df = docs_of(session, [(k, prose(rng, rng.randint(1, 40)), f"s{k % 3}") for k in range(300)])
    rows = mixing.training_order(df).collect()
    at = [r.position for r in rows]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    again = mixing.training_order(df.orderBy(F.rand(1))).collect()
    assert [(r.doc_id, r.epoch) for r in rows] == [(r.doc_id, r.epoch) for r in again]
    # The falling schedule of the third source is trained earlier than the rising one of the second.
    mean = lambda s: np.mean([r.position for r in rows if r.source == s])
    assert mean("s2") < mean("s0") < mean("s1")


# Token ids


def test_token_ids_against_the_library(session, odd_rows, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rng = random.Random(9)
    alphabet = list("ab 's't're\n\t'llve.,!12é漢ß☃😀　\xa0_-\r\x1c​")
    rows = [*odd_rows, *[(100 + k, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))), "z") for k in range(400)], (999, "a <|endoftext|> b", "z")]
    df = clashing(session, rows, ["key", "part", "place", "n_tokens", "ids", "start"])
    folder = str(tmp_path / "tokens")
    tokenids.write_tokens(df, folder, vocabulary("byte_bpe_50k.json"))
    got = sorted(((r.start, r.key, r.n_tokens, list(r.ids)) for r in tokenids.read_tokens(session, folder).collect()), key=lambda r: r[0])
    want = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start = 0
    assert len(got) == len(want)
    for (at, key, n, ids), (i, t) in zip(got, want, strict=True):
        expected = [*library.encode(t, add_special_tokens=False).ids, 0]
        assert (at, key, n, ids) == (start, i, len(expected), expected)
        start += n


def test_token_files_can_be_read_in_part(session, tmp_path):
    folder = str(tmp_path / "part")
    df = docs_of(session, [(k, prose(random.Random(k), 50), "a") for k in range(500)])
    tokenids.write_tokens(df, folder, vocabulary("byte_bpe_50k.json"))
    plan = session.read.parquet(folder).filter("key = 7").select("n_tokens")._jdf.queryExecution().toString()
    assert "EqualTo(key,7)" in plan and "ids" not in plan.split("ReadSchema")[-1]
    import pyarrow.dataset as ds
    import pyarrow.parquet as pq

    meta = pq.ParquetFile(ds.dataset(folder).files[0]).metadata.row_group(0)
    ids = meta.column(meta.num_columns - 1)
    assert ids.has_offset_index and any("DICTIONARY" in e for e in ids.encodings)
    folder = str(tmp_path / "none")
    tokenids.write_tokens(empty(session), folder, vocabulary("byte_bpe_50k.json"))
    assert tokenids.read_tokens(session, folder).count() == 0


def test_giant_text_is_cut_where_tokens_start(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenids, "PIECE", 50)
    text = prose(random.Random(1), 400) + "   \n\n  it's  we'll"
    mine = tokenids.Encoder(vocabulary("byte_bpe_50k.json")).encode([text, "", text])
    want = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert [list(x) for x in mine] == [want, [], want]


# Archive


def test_archive(session, tmp_path):
    big, small = "<p>" + "é" * 60, "short"
    rows = [(5, "http://a/", big), (3, "http://b/", big), (9, "http://c/", big), (4, None, None), (6, "http://d/", ""), (7, "x\r\ny", small), (8, "http://e/", small), (3, "http://b/", big), (None, "http://f/", big), (None, "http://g/", "only here" * 30)]
    df = session.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit("clash")).withColumn("key", F.lit(0))
    folder = str(tmp_path / "warc")
    warc.write_archive(df, folder)
    stored = session.read.parquet(f"{folder}/payloads").collect()
    assert len(stored) == len({(h or "") for _, _, h in rows}) and all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in stored)
    kinds = [(r.key, r.record_type, r.refers_to) for r in warc.read_records(session, folder).collect()]
    want = [(5, "revisit", 3), (9, "revisit", 3), (None, "revisit", 3), *[(k, "response", None) for k in (3, 3, 4, 6, 7, 8, None)]]
    assert sorted(kinds, key=str) == sorted(want, key=str)
    for r in warc.reconstruct(session, folder).collect():
        raw = bytes(r.record)
        head, _, rest = raw.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        body = rest[:-4]
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert int(fields[b"Content-Length"]) == len(body)
        if fields[b"WARC-Type"] == b"response":
            assert b"sha256:" + hashlib.sha256(body).hexdigest().encode() == fields[b"WARC-Payload-Digest"]
    folder = str(tmp_path / "empty")
    warc.write_archive(session.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.reconstruct(session, folder).count() == 0


# Spot signatures


def test_spotsigs_odd_rows(session, odd_rows):
    df = clashing(session, odd_rows, ["id", "fingerprint", "side", "part", "following"])
    got = spotsigs.edited_fingerprints(df).collect()
    want = sorted(((i, t or "") for i, t, _ in odd_rows), key=lambda r: r[1])
    want = sorted([r for r in want if r[0] is not None], key=lambda r: -r[0]) + [r for r in want if r[0] is None]
    edited = {}
    for k, (i, t) in enumerate(want):
        following = want[(k + 1) % len(want)][1]
        h = len(t) // 2
        edited.setdefault((i, len(t)), []).append(hashlib.sha256((t[: len(t) - h] + following[:h]).encode()).hexdigest())
    assert sorted((r.id if r.id is not None else -1, r.n_chars, r.edited_sha256) for r in got) == sorted((i if i is not None else -1, n, e) for (i, n), many in edited.items() for e in many)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints[r.id] = r.fingerprint
    assert prints[7] == prints[8] and prints[4] == prints[5] and prints[1] == prints[2] == prints[3] != prints[4]
    assert spotsigs.edited_fingerprints(empty(session)).collect() == []
    one = spotsigs.edited_fingerprints(docs_of(session, [(1, "the cat sat on the mat today", "a")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_spotsigs_pairs_against_brute_force(session):
    rng = random.Random(8)
    texts = []
    for _ in range(60):
        base = [rng.choice(["the", "of", "and", *WORDS]) for _ in range(rng.randint(30, 200))]
        texts.append(" ".join(base))
        for _ in range(2):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy))
    rows = [(k, t, "a") for k, t in enumerate([*texts, None, "", texts[0]])]
    members, near = spotsigs.near_pairs(docs_of(session, rows), least=0.8)
    import pyarrow as pa

    s, o = spotsigs.spot_signatures(pa.array([t or "" for _, t, _ in rows]))
    sets = [s[a:b] for a, b in zip(o[:-1], o[1:], strict=True)]
    first = {}
    for k, x in enumerate(sets):
        if len(x):
            first.setdefault(x.tobytes(), k)
    assert {(r.id, r["class"]) for r in members.collect()} == {(k, first[x.tobytes()]) for k, x in enumerate(sets) if len(x)}
    reps = sorted(first.values())
    want = {(a, b): spotsigs.likeness(sets[a], sets[b]) for i, a in enumerate(reps) for b in reps[i + 1 :]}
    got = {(r.a, r.b): r.likeness for r in near.collect()}
    assert got == pytest.approx({p: v for p, v in want.items() if v >= 0.8}) and got


# Near-duplicates


def shingles_of(text, size):
    w = SPACE.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset()


def brute_components(rows, size, similarity=0.8):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles_of(t, size))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if any(x and y and len(x & y) * 100 >= round(similarity * 100) * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_brute_force(session, size, odd_rows):
    rng = random.Random(size)
    rows = [(i, t) for i, t, _ in odd_rows if i is not None and i != 11]
    centre = [rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(150)]
    for k in range(120):  # one large family with edits from none to many
        copy = list(centre)
        for _ in range(rng.randint(0, 16)):
            copy[rng.randrange(len(copy))] = rng.choice(WORDS)
        rows.append((1000 + k, " ".join(copy)))
    passage = prose(rng, 40)
    for k in range(80):  # unrelated texts with one passage in common, and chains of edits
        rows.append((2000 + k, passage + " " + " ".join(rng.choice(WORDS) + str(rng.randrange(500)) for _ in range(rng.randint(20, 120)))))
    text = [rng.choice(WORDS) + str(rng.randrange(90)) for _ in range(100)]
    for k in range(40):
        text = list(text)
        for _ in range(rng.randint(1, 4)):
            text[rng.randrange(len(text))] = rng.choice(WORDS) + str(rng.randrange(90))
        rows.append((3000 + k, " ".join(text)))
    for k in range(60):
        rows.append((4000 + k, prose(rng, rng.randint(1, 8))))
    rng.shuffle(rows)
    df = clashing(session, [(i, t, "a") for i, t in rows], ["id", "n", "digest", "signature", "component", "rep", "q0", "set"])
    got = minhash.near_duplicates(df, size=size).collect()
    want = brute_components(rows, size)
    assert len(got) == len(rows)
    assert {r.id: r.component_id for r in got} == want
    sizes = {i: len(shingles_of(t, size)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.id] and r.kept == (r.id == r.component_id) for r in got)
    assert len(set(want.values())) < len(want) - 40


def test_near_duplicates_odd_tables(session, odd_rows):
    assert minhash.near_duplicates(empty(session)).collect() == []
    assert minhash.keep_one(empty(session)).collect() == []
    lone = minhash.near_duplicates(docs_of(session, odd_rows), size=2).filter("id IS NULL").collect()
    assert [(r.n_shingles, r.component_id, r.kept) for r in lone] == [(4, None, True)]
    df = clashing(session, odd_rows, ["_gone", "kept"])
    kept = minhash.keep_one(df, size=2)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 2, 3, 4, 6, 7, 9, 10, 11, 11, 12] and kept.filter("doc_id IS NULL").count() == 1
    twice = minhash.keep_one(df.unionAll(df), size=2)
    assert sorted(map(str, twice.collect())) == sorted(map(str, kept.collect()))


def test_match_threshold_bounds_the_miss():
    import math

    t = minhash.match_threshold(0.8, 64, 1e-6)
    tail = sum(math.comb(64, k) * 0.8**k * 0.2 ** (64 - k) for k in range(t))
    assert tail <= 1e-6 < tail + math.comb(64, t) * 0.8**t * 0.2 ** (64 - t)


def test_components_of_a_long_path(session):
    edges = session.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (200, 200)], "a long, b long")
    got = {r.id: r.component for r in minhash.components(edges).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


# Personal data

BASE = [
    (0, re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")), (1, re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    (2, re.compile(r"[0-9]([\x20-]?[0-9])+")), (3, re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in BASE:
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 0 or kind == 1 and all(int(p) <= 255 for p in m.group().split(".")) or kind == 2 and 13 <= len(digits) <= 19 and luhn(digits) or kind == 3 and 9 <= len(digits) <= 15:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_against_the_patterns():
    rng = random.Random(6)
    parts = ["4521940886194967", "192.168.0.1", "+47 22 33 44 55", " x@y.z ", "4000-0000 0000 0002", "1.2.3.4.5.6.7.8.9"]
    for _ in range(20_000):
        text = "".join(rng.choice("ab_%@.1+2 -(54") if rng.random() < 0.9 else rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1." * 100_000) is not None and pii.base_spans("a" * 300_000 + "@") == []


def test_field_adds_repeated_mentions_only(session):
    rng = random.Random(1)
    phone = lambda: "+" + str(rng.randint(1, 9)) + " " + " ".join(str(rng.randint(100, 999)) for _ in range(3))
    rows = [(k, f"{prose(rng, 20)} call {phone()} or {prose(rng, 10)} id {rng.randint(10**9, 10**10)} mail u{k}@m.example.com", "a") for k in range(400)]
    weights = pii.fit(docs_of(session, rows))
    text = "Call +4 722 334 455 now. " + prose(rng, 300) + " Later 722 334 455 again. Order 987 654 321 0."
    base = pii.base_spans(text)
    added = pii.added_spans(text, base, weights)
    assert [(k, text[a:b]) for k, a, b in base] == [(3, "+4 722 334 455")] and [(k, text[a:b]) for k, a, b in added] == [(3, "722 334 455")]
    assert pii.masked(text, base, added)[0].count("[PHONE]") == 2 and pii.added_spans("Order 987 654 321 0.", [], weights) == []


def test_field_needs_no_base_span(session):
    rng = random.Random(8)
    digits = lambda n: str(rng.randint(10 ** (n - 1), 10**n - 1))
    rows = [(k, f"{prose(rng, 20)} call +{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)} or {prose(rng, 10)} id {digits(10)}", "a") for k in range(400)]
    weights = pii.fit(docs_of(session, rows))
    text = f"Call (555) 123-4567 now. {prose(rng, 300)} Later call (555) 123-4567. 2 rooms are left, order 987 654 321 0."
    assert pii.base_spans(text) == []
    assert [(k, text[a:b]) for k, a, b in pii.added_spans(text, [], weights)] == [(3, "(555) 123-4567")] * 2
    masked = pii.redact(docs_of(session, [(1, text, "a"), (2, "Call (555) 123-4567 now.", "a")]), weights).collect()
    assert {r.doc_id: r.text.count("[PHONE]") for r in masked} == {1: 2, 2: 0}
    # A full stop and a blank end a number, a full stop alone does not.
    assert [text[n.start : n.end] for text in ("Or 722 334 455. 2 rooms, 722.334.455.", "722 334 455. 20 888 777 666") for n in pii.nodes(text, [])] == ["722 334 455", "722.334.455", "722 334 455", "20 888 777 666"]
    # Digits inside a word are no number.
    assert [n.whole for n in pii.nodes("key dafbac99949115180e75, key dafbac99949115180e75, tel7223344, 7223345x12, 7223346 ext", [])] == ["7223344", "7223345", "7223346"]


def test_redaction_odd_rows(session, odd_rows):
    df = clashing(session, odd_rows, ["masked", "absent", "spans"])
    got = pii.redact(df)
    assert got.columns == df.columns
    rows = {(r.doc_id, r.text) for r in got.collect()}
    assert (1, None) in rows and (12, "mail [EMAIL] now") in rows and (2, "") in rows and got.count() == len(odd_rows)
    assert pii.redact(empty(session)).collect() == []


def test_marginals_equal_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    weights = pii.Weights(rng.normal(size=(pii.N_FEATURES, 5)), rng.normal(size=(5, 5)), (1.5, 0.7))
    text = "call 22 33 44 55 66 or +47 900 10 200 now 12345678901"
    found = pii.nodes(text, pii.base_spans(text))
    chain = [(k, k + 1, 0) for k in range(len(found) - 1)]  # a tree, where belief propagation is exact
    pii_rounds, pii.ROUNDS = pii.ROUNDS, 60
    got = pii.marginals(text, found, chain, weights)
    pii.ROUNDS = pii_rounds
    total = np.zeros((len(found), 5))
    for labels in itertools.product(range(5), repeat=len(found)):
        score = sum(weights.unary[pii.features(text, n)].sum(0)[y] if n.label is None else (0 if y == n.label else -50) for n, y in zip(found, labels, strict=True))
        score += sum(weights.chain[labels[a], labels[b]] for a, b, _ in chain)
        for k, y in enumerate(labels):
            total[k, y] += np.exp(score)
    assert got == pytest.approx(total / total.sum(1, keepdims=True), abs=2e-3)


# Licences


def test_licences_odd_rows(session, odd_rows):
    text = dict((label, t) for label, t in licences.TEMPLATES if len(t) > 150)["apache"]
    rows = [*odd_rows, (50, "Some code. " + text + " The end.", "a"), (51, "mit license MIT-License and the GENERAL public (license)", "a"), (52, text.replace("implied", "any other kind"), "a")]
    got = {r.id: r for r in licences.scan(clashing(session, rows, ["id", "spans", "places", "n_words"])).collect()}
    for i, t, _ in rows:
        if i != 11:
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
            assert got[i].n_words == len(words)
    full = max(got[50].spans, key=lambda s: s.score)
    assert full.label == "apache" and full.score == 1.0 and full.start == 2 and max(s.score for s in got[52].spans if s.label == "apache") > 0.85
    assert sorted((p.label, p.word) for p in got[51].places) == [("gpl", 6), ("mit", 0), ("mit", 2)]
    assert licences.scan(empty(session)).collect() == []


def test_shared_wording_names_no_licence(session):
    rows = {
        "This work is licensed under the MIT License.": {"mit"}, "This work is licensed under the Example Licence.": set(), "This work is licensed under the Apache License, Version 2.0.": {"apache"},
        "This work is licensed under the GNU Free Documentation License.": set(), "This work is licensed under the GNU General Public License, version 3.": {"gpl"},
        "This work is licensed under the Example Public License, version 3.": set(), "Licensed under CC BY-NC 4.0.": {"cc"}, "Some text. Licensed under CC BY 3.0 by its author.": {"cc"}, "SPDX: CC-BY-SA-4.0": {"cc"},
        "Licensed under CC0 1.0 Universal.": {"cc"}, "This work is licensed under a Creative Commons Attribution 4.0 International License.": {"cc"}, "Licensed under rule 4.0 by the office.": set(),
    }
    got = licences.scan(docs_of(session, [(k, t, "a") for k, t in enumerate(rows)])).collect()
    spans = {r.id: {s.label for s in r.spans if s.score >= licences.COVER} for r in got}
    assert [(t, spans[k]) for k, t in enumerate(rows)] == list(rows.items())
    # A template's own text covers it whole, and covers half of no other licence.
    got = licences.scan(docs_of(session, [(k, t, "a") for k, (_, t) in enumerate(licences.TEMPLATES)])).collect()
    for r in got:
        assert {s.label for s in r.spans if s.score >= licences.COVER} == {licences.TEMPLATES[r.id][0]} and max(s.score for s in r.spans) == 1.0


def test_matching_statistics_against_brute_force():
    rng = random.Random(5)
    templates = [[rng.randrange(6) for _ in range(rng.randint(3, 30))] for _ in range(6)]
    automaton = licences.Automaton(templates)
    runs = {tuple(t[a:b]) for t in templates for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    text = [rng.randrange(7) for _ in range(400)]
    for k, (state, length) in enumerate(automaton.statistics(text)):
        best = max((n for n in range(31) if n == 0 or tuple(text[k + 1 - n : k + 1]) in runs and n <= k + 1), default=0)
        assert length == best
        if length:
            run = text[k + 1 - length : k + 1]
            places = {n: min(e for e in range(length - 1, len(t)) if t[e + 1 - length : e + 1] == run) for n, t in enumerate(templates) if any(t[e + 1 - length : e + 1] == run for e in range(length - 1, len(t)))}
            assert automaton.ends[state] == places


# Pieces


@pytest.fixture(scope="module")
def model(tmp_path_factory):
    """The given pieces read as a unigram model; scores the library's single precision cannot hold are raised."""
    from sentencepiece import sentencepiece_model_pb2

    m = sentencepiece_model_pb2.ModelProto()
    with open(vocabulary("piece_bpe_32k.model"), "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        p.score = max(p.score, -40_000.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(m.SerializeToString())
    return str(path)


def test_pieces_against_the_library(model):
    import sentencepiece

    library, mine = sentencepiece.SentencePieceProcessor(model_file=model), pieces.Pieces(model)
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(list("abcdethersionlu .,é漢☃\n")) for _ in range(rng.randint(1, 25)))
        assert mine.encode(text) == library.encode(text), text
        assert mine.decode(mine.encode(text)) == text


def test_ranks_are_read_as_probabilities(tmp_path):
    """The given merge file against the library's unigram model with the same scores; and it comes close to the merge order."""
    import math

    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    path = vocabulary("piece_bpe_32k.model")
    m = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.type == 1:
            p.score = -math.log(pieces.OFFSET - p.score)
    (tmp_path / "unigram.model").write_bytes(m.SerializeToString())
    library, merges = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "unigram.model")), sentencepiece.SentencePieceProcessor(model_file=path)
    mine = pieces.Pieces(path)
    rng = random.Random(4)
    texts = [" ".join(prose(rng, rng.randint(1, 12)).split()) for _ in range(300)]
    assert sum(mine.encode(t) == library.encode(t) for t in texts) >= 297  # single precision may break a tie
    total = sum(len(merges.encode(t)) for t in texts)
    assert abs(sum(len(mine.encode(t)) for t in texts) - total) < 0.05 * total
    assert all(mine.decode(mine.encode(t)) == t for t in texts)


@pytest.mark.parametrize("alphabet", ["ab cde\nthe in er", "abtheriongsx", "漢字ab ☃  ", "a"])
def test_chunks_equal_the_whole(session, model, alphabet, odd_rows, monkeypatch):
    rng = random.Random(len(alphabet))
    mine = pieces.vocabulary(model)
    rows = [(k, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))), "a") for k in range(8)] + [(90, "".join(rng.choice(alphabet) for _ in range(900)), "a")]
    rows += [(i, t and t[:700], s) for i, t, s in odd_rows]
    monkeypatch.setattr(pieces, "BLOCK", 8)  # two levels of the scan
    df = clashing(session, rows, ["id", "ids", "chunk", "doc", "state"])
    got = pieces.encode(df, model, chunk=20).collect()
    want = sorted((-1 if i is None else i, tuple(mine.encode(t or ""))) for i, t, _ in rows)
    assert sorted((-1 if r.id is None else r.id, tuple(r.ids)) for r in got) == want
    assert all(r.exact for r in got) and max(r.n_chunks for r in got) > 40
    back = pieces.decode(session.createDataFrame([(r.id, list(r.ids)) for r in got], "id long, ids array<int>"), model).collect()
    assert sorted((-1 if r.id is None else r.id, r.text) for r in back) == sorted((-1 if i is None else i, t or "") for i, t, _ in rows)


def test_long_texts_in_chunks(session, model, odd_rows):
    mine = pieces.vocabulary(model)
    got = pieces.encode(docs_of(session, odd_rows), model, chunk=3000).collect()
    assert sorted((-1 if r.id is None else r.id, tuple(r.ids)) for r in got) == sorted((-1 if i is None else i, tuple(mine.encode(t or ""))) for i, t, _ in odd_rows)
    assert all(r.exact for r in got) and max(r.n_chunks for r in got) > 20


def test_pieces_of_an_empty_table(session, model):
    assert pieces.encode(empty(session), model).collect() == []
    facts = pieces.digests(pieces.encode(docs_of(session, [(1, None, "a"), (2, "the", "a")]), model)).collect()
    assert {r.id: (r.n_tokens, r.ids_crc32) for r in facts}[1] == (0, zlib.crc32(b""))


# Quality


def plain_measures(t):
    w = SPACE.findall(t or "")
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    held = {}
    for x in windows:
        held[x] = held.get(x, 0) + 1
    covered = {p for k, x in enumerate(windows) if held[x] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in (t or "").split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_order(session, odd_rows):
    rng = random.Random(2)
    line = prose(rng, 12)
    rows = [*odd_rows, (60, "\n".join([line] * 20), "a"), (61, " ".join(["Ha"] * 90), "a"), (62, prose(rng, 70).replace(" ", "*** "), "a"), (63, prose(rng, 400).upper(), "a"), (64, " ".join(f"w{k % 97} x{k}" for k in range(300)), "a")]
    df = clashing(session, rows, ["n_words", "_text", "rejected_by", "_row", "lines"])
    every = [r.column for r in quality.contract_rules()]
    got = quality.cascade(df, quality.contract_rules(), report=every).select(F.col("_row.doc_id").alias("i"), F.col("_row.text").alias("t"), "n_words", "word_chars", "n_symbols", "lines", "n_repeat_words", "rejected_by").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.lines.dup, r.n_repeat_words) == plain_measures(r.t), r.i
    rejected = {r.i: r.rejected_by for r in got}
    assert rejected[60] and rejected[61] and rejected[62] and rejected[63] and rejected[64] is None and rejected[1] == "few words"
    # The order of the rules changes no verdict.
    kept = {r.doc_id for r in quality.keep(df, quality.contract_rules()).collect()}
    turned = {r.doc_id for r in quality.keep(df, tuple(reversed(quality.contract_rules()))).collect()}
    assert kept == turned == {i for i, why in rejected.items() if why is None}
    # A text is not rejected for being short.
    standard = quality.keep(df)
    assert standard.columns == df.columns and {4, 6, 12, 64} <= {r.doc_id for r in standard.collect()} and not {1, 2, 3, 60, 61, 62, 63} & {r.doc_id for r in standard.collect()}
    assert quality.keep(empty(session)).collect() == []


def test_clean_short_texts_may_repeat_a_line(session):
    rng = random.Random(6)
    # Every word its own, so that no other rule has a say.
    body = lambda n: " ".join(f"{rng.choice(WORDS)}{k}" for k in range(n))
    head, long_line = "A heading of five words", body(40)
    rows = [
        (1, f"{head}\n{body(70)}\n{head}", "a"), (2, f"{head}\n{body(30)}\n{head}\n{body(30)}\n{head}\n{body(30)}", "a"), (3, f"{long_line}\n{body(20)}\n{long_line}", "a"), (7, f"{head}\n{head}", "a"), (8, "De.", "a"),
        (4, "\n".join([*["Read more here"] * 10, body(30)]), "a"), (5, "\n".join([f"{body(500)}\n{head}"] * 1 + [f"{body(9)}\n{head}" for _ in range(300)]), "a"), (6, f"\r\n \n{head}\n{body(60)}\n\n\n", "a"),
        (9, "the the old old house house on on the the hill hill", "a"), (10, "so so it was", "a"), (11, " ".join(f"{w} {w}" for w in body(8).split()), "a"),
    ]
    got = quality.cascade(docs_of(session, rows), [quality.LINES], report=["lines"]).select("_row.doc_id", "_row.text", "n_words", "lines", "rejected_by").collect()
    for r in got:
        seen, held, again = set(), 0, 0
        for line in (x for x in r.text.split("\n") if SPACE.search(x)):
            held += len(SPACE.findall(line)) if line in seen else 0
            again += line in seen
            seen.add(line)
        assert (r.lines.words, r.lines.dup) == (held, again) and (r.rejected_by is not None) == (again >= 3 and held * 5 > r.n_words), r.doc_id
    assert {r.doc_id for r in got if r.rejected_by} == {4, 5}
    assert {r.doc_id for r in quality.keep(docs_of(session, rows)).collect()} == {1, 2, 3, 6, 7, 8, 10}


@pytest.mark.parametrize("short", [False, True])
def test_labelled_clean_documents_stay(session, short):
    """Clean-labelled documents of the given table are kept, short ones too; most labelled as junk go."""
    folder = "/root/testdata/sf0.01"
    docs = session.read.parquet(f"{folder}/documents.parquet").join(session.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = [r for r in docs.collect() if (len(SPACE.findall(r.text)) < 50) == short]
    kept = {r.doc_id for r in quality.keep(docs).collect()}
    clean, junk = ({r.doc_id for r in rows if r.quality == q} for q in (1, 0))
    assert clean and clean <= kept and len(junk & kept) <= 0.1 * len(junk)


def test_rules_go_by_rejection_per_cost():
    rule = lambda name: quality.Rule(name, name, None, None)
    costs = [(rule("slow"), 1.0, 0.5), (rule("fast"), 0.1, 0.1), (rule("idle"), 0.01, 0.0), (rule("best"), 0.1, 0.4)]
    assert [r.name for r in quality.order(costs)] == ["best", "fast", "slow", "idle"]


# URL lists


def test_lists_as_of_against_brute_force(session):
    import datetime as dt

    rng = random.Random(7)
    day = lambda n: dt.date(2023, 1, 1) + dt.timedelta(days=n)
    hosts = [f"{a}.{b}.org" for a in ("www", "m", "blog") for b in ("x", "y", "z")]
    captures = [(k, f"HTTP://user@{rng.choice(hosts).upper()}:80/{rng.choice(['en', 'de', ''])}/p?q#f", day(rng.randint(0, 900))) for k in range(400)]
    captures += [(k, captures[k][1], day(rng.randint(0, 900))) for k in range(40)]  # the same page at another date
    captures += [(900, None, day(5)), (901, "no url", day(5)), (902, "http://www.x.org/en", None), (None, "http://www.x.org/", day(10)), (903, "http://www.x.org/", day(10)), (903, "http://www.x.org/", day(10))]
    keys = hosts + [h + "/en" for h in hosts] + ["*.x.org", "*.org"]
    entries = [(rng.choice(keys), rng.choice(["block", "allow"]), day(rng.randint(0, 900))) for _ in range(150)]
    entries += [entries[0], (None, "block", day(1)), ("www.x.org", None, day(1)), ("www.x.org", "block", None)]
    df = session.createDataFrame(captures, "page_id long, url string, fetched date").withColumn("key", F.lit("clash")).withColumn("bucket", F.lit(1))
    listed = session.createDataFrame(entries, "key string, action string, date date")
    rows = urlfilter.as_of_filter(df, listed, "page_id").collect()
    assert sorted((str(r.id), str(r.url), str(r.fetched)) for r in rows) == sorted((str(i), str(u), str(a)) for i, u, a in captures)
    got = {(r.id, r.url, r.fetched): r for r in rows}
    daily = {}
    for key, action, date in entries:
        if key and action and date:
            daily.setdefault(key, {})[date] = max(action, daily.get(key, {}).get(date, ""))
    for i, url, at in captures:
        m = re.match(r"[a-z]+://(?:[^@/]*@)?([^/:?#]+)(?::\d*)?(?:/([^/?#]*))?", url.lower()) if url else None
        active = []
        if m and at:
            host, part = m.group(1), m.group(2)
            labels = host.split(".")
            order = ([f"{host}/{part}"] if part else []) + [host] + ["*." + ".".join(labels[k:]) for k in range(len(labels))]
            for key in order:
                past = [d for d in daily.get(key, {}) if d <= at]
                if past:
                    active.append((key, daily[key][max(past)]))
        want = (len(active), active[0][0] if active else None, active[0][1] if active else None, not active or active[0][1] != "block")
        r = got[i, url, at]
        assert (r.n_active, r.matched_key, r.action, r.allowed) == want, (i, url, at)
    assert any(got[c].allowed != got[d].allowed for c, d in zip(captures[:40], captures[400:440], strict=True))
    assert urlfilter.as_of_filter(df.limit(0), listed, "page_id").collect() == []
    nothing = urlfilter.as_of_filter(df, listed.limit(0), "page_id").collect()
    assert len(nothing) == len(captures) and all(r.allowed for r in nothing)

"""Nothing is taken for something else: words of one pattern, repeated numbers, damaged payloads."""

import pytest
from pyspark.errors import PySparkException

import numpy as np

from attesta.llm import minhash, pii, simhash, spotsigs, tokenids, warc, wordhash
from attesta.llm.common import ready


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


def thue_morse(n, a="a", b="b"):
    """Two words whose polynomials agree modulo 2^64 for any odd base once they are long enough."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


@pytest.mark.parametrize("n", [64, 1024, 2048, 4096])
def test_token_ids_of_words_of_one_pattern(n):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    one, two = thue_morse(n)
    texts = [f"see {one} and", f"see {two} and {one}", two, f"{two} {two}"]
    library = Tokenizer.from_file(path)
    encoder = tokenids.Encoder(path)
    for some in (texts, texts[::-1], [" ".join(texts)]):
        assert [x.tolist() for x in encoder.encode(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_a_found_token_is_compared(monkeypatch):
    """With a hash that tells nothing apart every pre-token still gets its own ids."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(tokenids, "mix", lambda h: np.zeros_like(h))
    texts = ["all of these words differ", "", "don't they?  12 x"]
    library = Tokenizer.from_file(path)
    assert [x.tolist() for x in tokenids.Encoder(path).encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [4096])
def test_word_hashes_of_one_pattern(session, n):
    import pyarrow as pa

    one, two = thue_morse(n)
    h, _ = wordhash.words(*wordhash.buffers(pa.array([one, two])))
    assert h[0] != h[1]
    rows = [(1, f"{one} {two} {one}"), (2, f"{two} {one} {two}")] + [(3, one), (4, two)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: r.component_id for r in minhash.near_duplicates(docs, size=2).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}  # 1 and 2 hold the same two pairs of words
    prints = {r.id: r.fingerprint for r in spotsigs.fingerprints(docs).collect()}
    assert len(set(prints.values())) == 4


def test_running_sums_of_long_segments(monkeypatch):
    rng = np.random.default_rng(2)
    piece = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = np.sort(rng.choice(4900, 50, replace=False))
    ends = starts + rng.integers(1, 100, 50)
    whole = wordhash.polynomials(piece, starts, ends)
    monkeypatch.setattr(wordhash, "SEGMENT", 512)
    assert (wordhash.polynomials(piece, starts, ends) == whole).all()
    same = [wordhash.polynomials(piece[a:b], np.array([0]), np.array([b - a]))[0] for a, b in zip(starts, ends, strict=True)]
    assert same == whole.tolist()


def test_fingerprints_in_windows(monkeypatch):
    text = ("Some Words\tand  lines\n" * 300 + "end").encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint(text) == whole


@pytest.fixture(scope="module")
def fitted(session):
    """Weights of the query's own documents, and of very few rows."""
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    few = session.createDataFrame([(k, f"call +1 555 {k:03d} {k * 7 % 10000:04d} or write a{k}@b.org, order 12345{k:03d}") for k in range(40)], "doc_id long, text string")
    return pii.fit(docs), pii.fit(few), pii.train([], [])


@pytest.mark.parametrize("times", [1, 2, 3, 5, 10, 40])
@pytest.mark.parametrize("again", ["722-334-455", "722334455", "4722334455", "722 334 455", "(722) 334-455", "0722334455"])
def test_repeats_of_a_base_number_are_all_found(fitted, times, again):
    text = "reach us at +4 722 334 455 now. " + " ".join([f"then {again} again."] * times)
    again_at = text.find("then")
    text = text[:again_at] + text[again_at:].replace("4722334455", "4-722334455") if again == "4722334455" else text
    base = pii.base_spans(text)
    assert [k for k, _, _ in base] == [3]
    for weights in fitted:
        found = pii.added_spans(text, base, weights)
        assert len(found) == times and all(k == 3 for k, _, _ in found)
        assert "334" not in pii.masked(text, base, found)[0]


def test_the_sample_is_bounded(session, monkeypatch):
    rows = [(None, " ".join(f"+1 555 {k:03d} {j:04d}" for j in range(60))) for k in range(30)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(pii, "train", lambda nodes, pairs: seen.append((len(nodes), len(pairs))))
    pii.fit(docs, sample_nodes=100)
    assert seen == [(100, 100)]


def test_damaged_and_missing_payloads_stop_the_job(session, tmp_path):
    from pyspark.sql import functions as F

    pages = session.createDataFrame([(k, f"http://x/{k}", f"page {k % 3} " * 40) for k in range(6)], "page_id long, url string, html string")
    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    assert warc.reconstruct(session, folder).count() == 6
    rows = session.read.parquet(f"{folder}/payloads").collect()
    schema = session.read.parquet(f"{folder}/payloads").schema
    for name, some in {"damaged": [r.asDict() | ({"payload": b"x" * r.payload_bytes} if k == 0 else {}) for k, r in enumerate(rows)], "short": [r.asDict() for r in rows[1:]]}.items():
        at = str(tmp_path / name)
        session.read.parquet(f"{folder}/records").write.parquet(f"{at}/records")
        session.createDataFrame([tuple(r[f] for f in schema.names) for r in some], schema).write.parquet(f"{at}/payloads")
        with pytest.raises(PySparkException, match="archived payload"):
            warc.reconstruct(session, at).select(F.sum(F.length("record"))).collect()

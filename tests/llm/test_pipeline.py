"""The corpus pipeline whole: every stage's rows against plain Python."""

import random
import re
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import public_tokenizers
from pyspark.sql import functions as F
from test_llm_small import SPACE, brute_components, docs_of, plain_measures, plain_spans, prose

import corpus_pipeline
from attesta.llm import mixing, pieces
from attesta.llm.common import ready
from attesta.session import checkpoint_folder

KINDS = ("EMAIL", "IP", "CARD", "PHONE")


def passes(t):
    t = t or ""
    n, chars, symbols, _, _ = plain_measures(t)
    lines = [x for x in (t or "").split("\n") if SPACE.search(x)]
    again = sum(len(SPACE.findall(x)) for k, x in enumerate(lines) if x in lines[:k])
    lines = [x for x in t.split("\n") if SPACE.search(x)]
    repeats = len(lines) - len(set(lines))
    shouted = len(re.findall("[A-Z]{2,}", t))
    once = plain_measures("\n".join(dict.fromkeys(t.split("\n"))))[4]
    words = SPACE.findall(t)
    beside = sum(a == b for a, b in zip(words, words[1:])) if n < 50 else 0
    sound = n > 0 and symbols * 10 <= n and n * 2 <= chars <= n * 12 and not (repeats >= 3 and again * 5 > n) and not (shouted >= 4 and shouted * 10 > n * 3)
    return sound and once * 2 <= n and not (beside >= 3 and beside * 4 > n)


def hidden(t):
    for kind, a, b in sorted(plain_spans(t), key=lambda s: -s[1]):
        t = f"{t[:a]}[{KINDS[kind]}]{t[b:]}"
    return t


def plain_mix(docs, unit):
    """Ids of whole copies in training order, from {id: (source, text)} and each id's place in its source."""
    size = {i: len(SPACE.findall(t)) for i, (_, t) in docs.items()}
    names = sorted({s for s, _ in docs.values()})
    total = {n: sum(size[i] for i, (s, _) in docs.items() if s == n) for n in names}
    weight = {n: mixing.CYCLE[k % 3] for k, n in enumerate(names)}
    target, left = {}, 1.5 * sum(total.values())
    while open_ := [n for n in names if n not in target]:
        w = sum(weight[n] for n in open_)
        full = [n for n in open_ if left * weight[n] / w > 2 * total[n]]
        target |= {n: 2.0 * total[n] for n in full} if full else {n: left * weight[n] / w for n in open_}
        left -= sum(2.0 * total[n] for n in full)
    out = []
    for k, n in enumerate(names):
        a, b = mixing.RAMPS[k % 3]
        start = 0
        for i in sorted((i for i, (s, _) in docs.items() if s == n), key=unit.get):
            for begin in (start, start + total[n]):
                if begin + size[i] / 2 <= target[n]:
                    d = min(1.0, begin / target[n])
                    out.append((d if a == b else (((a * a + (b * b - a * a) * d) ** 0.5) - a) / (b - a), i))
            start += size[i]
    return [i for _, i in sorted(out)]


def test_every_stage_against_plain_python(spark, tmp_path):
    session, rng = ready(spark), random.Random(11)
    texts = [prose(rng, rng.randint(70, 140)) for _ in range(24)]
    heading = "a short heading"
    texts += [texts[0], texts[0], texts[3] + " end", texts[5].replace(" ", "  ", 1)]  # copies and near copies
    texts += [f"{prose(rng, 60)} mail u{k}.x@example.com or call +{k + 1} 555 01{k} 77{k} from 10.0.{k}.7 {prose(rng, 20)}" for k in range(6)]
    texts += [None, "", " \n", prose(rng, 49), "\n".join([prose(rng, 12)] * 20), prose(rng, 70).replace(" ", " *** "), prose(rng, 90).upper(), " ".join(["ha"] * 90)]  # junk
    texts += [f"{heading}\n{prose(rng, 80)}\n{heading}"]  # clean, with one repeated line
    rows = [(k, t, "abcd"[k % 4]) for k, t in enumerate(texts)]
    docs_of(session, rows).write.parquet(f"{tmp_path}/documents.parquet")
    folder = Path(checkpoint_folder(session).removeprefix("file:"))
    before = set(folder.glob("pipeline-*"))
    result = corpus_pipeline.run(session, str(tmp_path)).collect()
    (made,) = set(folder.glob("pipeline-*")) - before
    stage = [[r for f in sorted(made.glob(f"{k}/*.parquet")) for r in pq.read_table(f).to_pylist()] for k in range(5)]
    source = {i: s for i, _, s in rows}

    def holds(k, want):
        assert sorted((r["doc_id"], r["text"]) for r in stage[k]) == sorted(want.items())
        assert all(list(r) == ["doc_id", "text", "lang", "source", "n_chars"] and (r["lang"], r["source"], r["n_chars"]) == ("en", source[r["doc_id"]], len(r["text"])) for r in stage[k])

    clean = {i: t for i, t, _ in rows if passes(t)}
    assert len(clean) == 35 and len(rows) - 1 in clean
    holds(0, clean)
    one = {i: clean[i] for i, root in brute_components(list(clean.items()), 5).items() if i == root}
    assert len(one) == 31
    holds(1, one)
    masked = {i: hidden(t) for i, t in one.items()}
    assert sum(masked[i] != one[i] for i in one) == 6
    holds(2, masked)
    hashes = session.createDataFrame([(i,) for i in masked], "i long").select("i", F.shiftrightunsigned(F.xxhash64(F.lit(17), F.col("i").cast("string")), 1).alias("h")).collect()
    order = plain_mix({i: (source[i], t) for i, t in masked.items()}, {r.i: r.h for r in hashes})
    assert [r["doc_id"] for r in stage[3]] == order and 2 == max(Counter(order).values())
    assert all(r["text"] == masked[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in stage[3])
    # Every copy is encoded, and decodes to its text.
    assert Counter(r["doc_id"] for r in stage[4]) == Counter(order) == Counter(r.doc_id for r in result)
    tool = pieces.vocabulary(public_tokenizers.path(corpus_pipeline.MODEL))
    assert all(list(r) == ["doc_id", "n_tokens", "ids"] and r["n_tokens"] == len(r["ids"]) and tool.decode(r["ids"]) == masked[r["doc_id"]] for r in stage[4])
    assert [f"{s.__name__}" for _, s in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "personal_data", "mix_sources", "encode_pieces"]

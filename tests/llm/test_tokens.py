"""Token counts, alignments and resampling against the libraries and brute force, and on awkward tables."""

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter
from statistics import mean

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from test_operators import AWKWARD, awkward_rows
from tokenizers import Tokenizer

from postmill.llm import align, encode, resample, tokencounts
from postmill.llm.pieces import Pieces

BYTE, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PARTS = [" ", "  ", "\n", "\t", "\r", "▁", "hello", "Wörld", "中文", "\x00", "'", ".", "12", "😀", "int main(){\r\n", "<s>", "<|endoftext|>", "\x85", " the", "ing", " recommendation", "<0x0A>"]


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows() + [(50 + i, t) + awkward_rows()[0][2:] for i, t in enumerate(("▁", "a▁b", "<s>", " ", "\n", "<|endoftext|> x"))], AWKWARD)


@pytest.fixture(scope="module")
def pieces():
    return SentencePieceProcessor(model_file=PIECE)


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


# 2


def test_known_pieces_are_encoded_faster_than_arrow_lists_them(tools):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = pa.array([" w" + "".join(letters[i // 26**k % 26] for k in range(4)) for i in range(60_000)])
    text, encoder = "".join(words.to_pylist()), encode.Encoder(BYTE)
    data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])

    def least(call):
        times = []
        for _ in range(5):
            began = time.process_time()
            call()
            times.append(time.process_time() - began)
        return min(times)

    assert encoder._chunk(data, offsets) == [np.array(tools[0].encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert least(lambda: encoder._chunk(data, offsets)) < least(words.to_pylist)


# 11


def test_pre_tokens_have_the_pieces_of_the_whole_text(pieces):
    model, texts = Pieces(PIECE), random_texts(2000)
    assert model.cuttable
    for cuttable in (True, False):
        model.cuttable = cuttable
        for row, data, offsets in align.W.chunks(model.prepared(pa.array(texts)), 1 << 13):
            found, keys, rows = model.pre_tokens(data, offsets)
            ids = model.ids(found.to_pylist())
            for r in range(len(offsets) - 1):
                assert [x for k in keys[rows == r] for x in ids[k]] == pieces.encode(texts[row + r])


def test_token_counts_equal_the_library(spark, docs, awkward, pieces, monkeypatch):
    monkeypatch.setattr(tokencounts.sparse, "BUCKET_BYTES", 1 << 16)
    for table in (docs, awkward):
        found = Counter(map(tuple, tokencounts.token_counts(table, PIECE).collect()))
        texts = [(r.doc_id, r.text or "") for r in table.collect()]
        assert found == Counter((d, len(t.encode()), len(pieces.encode(t)), len(pieces.encode(t)) > 4096) for d, t in texts)
    assert tokencounts.token_counts(awkward.limit(0), PIECE).count() == 0
    named = tokencounts.token_counts(awkward.selectExpr("cast(doc_id as string) as doc_id", "text", "1 as n_bytes", "2 as chunk"), PIECE, limit=5)
    assert named.where("over_limit").count() == sum(len(pieces.encode(r.text or "")) > 5 for r in awkward.collect())


# 12


def token_bytes(tokenizer, letters, i):
    return bytes(letters[c] for c in tokenizer.id_to_token(i))


def brute_alignment(text, tokenizer, letters, pieces):
    """(A ids, B ids, places of both in links, text of the groups) by comparing all ends."""
    if not text:
        return [], [], [], ""
    a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
    sides = [[token_bytes(tokenizer, letters, i) for i in a], [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]]
    if any(b"".join(s) != (" " + text).encode() for s in sides):
        return [], [], [], ""
    ends = [np.cumsum([len(x) for x in s]).tolist() for s in sides]
    links = [(i, ends[1].index(e)) for i, e in enumerate(ends[0]) if e in set(ends[1])]
    parts, i, j = [], 0, 0
    for x, y in links:
        parts.append(",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
        i, j = x + 1, y + 1
    return a, b, links, ";".join(parts)


@pytest.fixture(scope="module")
def tools(pieces):
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    tokenizer = Tokenizer.from_file(BYTE)
    tokenizer.encode_special_tokens = True
    return tokenizer, letters, pieces


def test_gallop_is_a_lower_bound():
    rng = np.random.default_rng(3)
    for _ in range(200):
        ends = np.unique(rng.integers(1, 400, rng.integers(1, 120)))
        values = np.sort(rng.integers(1, ends[-1] + 1, rng.integers(1, 90)))
        low, high = np.zeros(len(values), np.int64), np.full(len(values), len(ends))
        guess = rng.integers(0, len(ends), len(values))
        assert (align.gallop(values, ends, low, high, guess) == np.searchsorted(ends, values)).all()


def test_alignment_equals_brute_force(tools):
    texts = random_texts(400, 2) + ["", None, "x" * 70_000, "one long text, " * 4000]
    x = align._Pair(BYTE, PIECE).aligned(pa.array(texts, pa.string()))
    raw, starts = align.group_texts(x)
    (a, b), (first, last) = x.links(), x.overlaps()
    for d, text in enumerate(texts):
        if len(text or "") > 1000:
            continue
        a_ids, b_ids, links, groups = brute_alignment(text, *tools)
        at, to, base = x.a_start[d], x.a_start[d + 1], x.b_start[d]
        assert x.a_ids[at:to].tolist() == a_ids and x.b_ids[base : x.b_start[d + 1]].tolist() == b_ids
        own = (a >= at) & (a < to)
        assert list(zip((a[own] - at).tolist(), (b[own] - base).tolist(), strict=True)) == links
        assert raw[starts[d] : starts[d + 1]].tobytes().decode()[:-1] == groups
        if a_ids:
            tokenizer, letters, pieces = tools
            e = [np.cumsum([len(token_bytes(tokenizer, letters, i)) for i in a_ids]), np.cumsum([1 if pieces.is_byte(i) else len(pieces.id_to_piece(i).replace("▁", " ").encode()) for i in b_ids])]
            s = [np.r_[0, v[:-1]] for v in e]
            for i in range(len(a_ids)):
                over = np.flatnonzero((e[1] > s[0][i]) & (s[1] < e[0][i]))
                assert (first[at + i] - base, last[at + i] - base) == (over[0], over[-1])


def test_link_statistics_equal_brute_force(spark, docs, awkward, tools, monkeypatch):
    monkeypatch.setattr(align.sparse, "BUCKET_BYTES", 1 << 17)
    long = 5000  # the brute force is quadratic
    for table in (docs.where(f"length(text) < {long}"), awkward.where(f"text is null or length(text) < {long}")):
        rows = [(r.doc_id, *brute_alignment(r.text, *tools)) for r in table.collect()]
        counts = Counter((a[i], b[j]) for _, a, b, links, _ in rows for i, j in links)
        best = {}
        for (_, y), n in counts.items():
            best[y] = max(best.get(y, 0), n)
        expected = Counter()
        for doc_id, a, b, links, groups in rows:
            found = [(a[i], b[j]) for i, j in links]
            sha = hashlib.sha256(groups.encode()).hexdigest() if a else ""
            expected[(doc_id, len(a), len(b), len(links), len(links), sum(counts[k] == best[k[1]] for k in found), sum(counts[k] for k in found), sha)] += 1
        assert Counter(map(tuple, align.link_statistics(table, BYTE, PIECE).collect())) == expected
    assert align.link_statistics(awkward, BYTE, PIECE).count() == awkward.count()
    assert align.link_statistics(awkward.limit(0), BYTE, PIECE).count() == 0


def test_a_chunk_is_aligned_in_parts_of_bounded_memory(monkeypatch):
    words = [f"word{i}" for i in range(500)]
    rng = random.Random(4)
    texts = [" ".join(rng.choices(words, k=600)) for _ in range(750)]
    batch = pa.record_batch([pa.array(range(750)), pa.array(texts)], names=["doc_id", "text"])
    assert batch.column(1).nbytes > 3 << 20
    run = align._chunks(BYTE, PIECE, 4)
    list(run([batch.slice(0, 50)]))  # the tokenizers are loaded, the words known
    tracemalloc.start()
    (whole,) = run([batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20
    for most in (1 << 24, 10_000):
        monkeypatch.setattr(align, "PART_BYTES", most)
        (other,) = run([batch])
        assert other.drop_columns("chunk").equals(whole.drop_columns("chunk"))


def test_aligned_spans_of_a_table(awkward, tools):
    for row in align.align_tokens(awkward.where("text is null or length(text) < 1000"), BYTE, PIECE).join(awkward.select("doc_id", "text"), "doc_id").where("doc_id not in (0, 3)").collect():
        a, b, links, _ = brute_alignment(row.text, *tools)
        assert (row.a_ids, row.b_ids, row.group_a, row.group_b) == (a, b, [i + 1 for i, _ in links], [j + 1 for _, j in links])
        assert len(row.first_b) == len(row.last_b) == len(a)
        assert all(x <= y for x, y in zip(row.first_b, row.last_b, strict=True))


# 13


def brute_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_resample(rows, targets):
    docs = [(d, *brute_features(t)) for d, t in rows]
    s, t = Counter(x for _, _, f in docs for x in f), Counter(x for y in targets for x in brute_features(y)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in s}
    out = []
    for d, n, f in docs:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f)
        out.append((d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    return out, able[: 5 * len(able) // 100]


def test_resampling_equals_brute_force(spark, docs, awkward, small):
    target = spark.read.parquet(f"{small}/benchmark.parquet")
    for table in (docs, docs.select("doc_id", "text").unionByName(docs.select("doc_id", "text")), awkward):
        every, chosen = brute_resample([(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()], [r.text for r in target.collect()])
        found = resample.resample(table, target).collect()
        assert Counter(tuple(r)[:4] for r in found) == Counter((d, f, w, s) for d, _, f, w, s in every)
        ranks = sorted((r["rank"], r.doc_id, r.score) for r in found if r["rank"])
        assert ranks == [(i, c[0], c[4]) for i, c in enumerate(chosen, 1)]
    assert resample.resample(docs.limit(0), target).count() == 0
    _, chosen = brute_resample([(r.doc_id, r.text) for r in docs.collect()], [])
    assert {r.doc_id for r in resample.resample(docs, target.limit(0)).where("rank is not null").collect()} == {c[0] for c in chosen}


def test_hashes_of_long_words_and_mixed_letters():
    texts = ["A" * 300 + " Bc é" + "x" * 256 + " d", "", "Ünï CODE-words 12ab", "\x00\x7f"]
    parts = list(resample.ngram_crcs([t.encode() for t in texts]))
    for d, text in enumerate(texts):
        got = [int(c) % 10_000 for rows, crc in parts for c in crc[rows == d]]
        assert got == brute_features(text)[1]


def test_drawn_rows_are_nearer_to_the_target(spark, docs, small):
    """Documents that a target was cut from are drawn far more often than others."""
    texts = [r.text for r in docs.where("length(text) > 400").orderBy("doc_id").collect()]
    target = spark.createDataFrame([(t[:300],) for t in texts[::10]], "text string")
    found = resample.resample(docs, target, percent=10).join(docs.select("doc_id", "text"), "doc_id").collect()
    wanted = set(texts[::10])
    share = lambda rows: mean(r.text in wanted for r in rows)
    assert share([r for r in found if r["rank"]]) > 2 * share(found)

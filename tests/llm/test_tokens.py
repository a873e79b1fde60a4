"""Tokenizers against their libraries, decontamination, scores and the pipeline against brute force."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from powerflow.llm import byte_bpe, decontaminate, exact_dedup, kneser_ney, piece_counts, quality
from tests.llm.test_dedup import classes_by_definition
from tests.llm.test_words import UPPER, words_by_definition

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
HARD = st.text(
    st.one_of(st.sampled_from(list("the  \n\t'sll0é日ß😀▁<s>\x00\x1c\x85\xa0\u3000.,")), st.characters(exclude_categories=["Cs"])), max_size=60
)


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=HARD)
def test_byte_bpe(codec, library, text):
    ids = codec.encode(text).tolist()
    assert ids == library.encode_ordinary(text)
    assert "".join(codec.decode(ids)) == text


def test_byte_bpe_long_texts(codec, library):
    for text in ("a" * 5000, "日本語" * 800, "ab c\n\n" * 900, "the and " * 900):
        assert codec.encode(text).tolist() == library.encode_ordinary(text)


def test_transducer_survives_its_bounds(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_STATES", 50)
    monkeypatch.setattr(byte_bpe, "MAX_PAIRS", 20)
    monkeypatch.setattr(byte_bpe, "KNOWN_BYTES", 500)
    monkeypatch.setattr(byte_bpe, "LONG_PIECE", 9)
    monkeypatch.setattr(byte_bpe, "BATCH_CHARS", 30)
    small = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    texts = ["straightforward interpolation", "", "unbelievable occurrences everywhere", "naïve façade", "naïve façade"]
    for _ in range(2):
        packed = list(small.encode_many(texts))
        assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [library.encode_ordinary(t) for t in texts]


def test_vocabulary_without_a_byte(tmp_path, monkeypatch):
    path = tmp_path / "v.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate([b"a", b"b", b"ab"])))
    own = byte_bpe.Codec(str(path), r"\S+|\s+")
    assert own.encode("abab").tolist() == [2, 2] and own.encode("").tolist() == []
    for long in (96, 1):
        monkeypatch.setattr(byte_bpe, "LONG_PIECE", long)
        for text in ("abc", "cab", "aca"):
            with pytest.raises(ValueError, match="no token for a byte"):
                own.encode(text)


def test_table_of_moves_keeps_every_key():
    rng = np.random.default_rng(1)
    moves, kept = byte_bpe.Moves(), {}
    for _ in range(40):
        keys = np.setdiff1d(rng.integers(0, 1 << 34, 700), np.array(list(kept), dtype=np.int64))
        values = rng.integers(0, 1 << 30, len(keys)).astype(np.int32)
        moves.add(keys, values, values + 1)
        kept |= dict(zip(keys.tolist(), values.tolist(), strict=True))
    keys = np.array(list(kept))
    at = moves.places(keys)
    assert (moves.key[at] == keys).all() and moves.to[at].tolist() == list(kept.values())
    assert (moves.token[at] == moves.to[at] + 1).all() and moves.size == len(kept)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.lists(st.integers(0, 40), max_size=5))
def test_utf8_machine(data, cuts):
    machine = byte_bpe.Utf8Decoder()
    cuts = [0, *sorted(min(c, len(data)) for c in cuts), len(data)]
    got = "".join(machine.feed(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)) + machine.finish()
    assert got == data.decode("utf-8", "replace")


def test_byte_bpe_rows(documents, library):
    texts = ["Hello  world", None, "", "x" * 9000]
    df = documents(texts)
    rows = byte_bpe.round_trip(df, RANKS, public_tokenizers.PATTERN).collect()
    for row in rows:
        text = texts[row["doc_id"]] or ""
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert row["bpe"]["n_tokens"] == len(ids) and row["bpe"]["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row["bpe"]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    ids = df.select(byte_bpe.encode_ids(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("i"))
    back = ids.select(byte_bpe.decode_ids(F.col("i"), RANKS, public_tokenizers.PATTERN).alias("t")).collect()
    assert [r["t"] for r in back] == [t or "" for t in texts]


@pytest.fixture(scope="module")
def pieces_model():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def counters():
    return [piece_counts.PieceCounter(PIECES), piece_counts.PieceCounter(PIECES, 24, 6), piece_counts.PieceCounter(PIECES, 5, 1)]


@settings(max_examples=300, deadline=None)
@given(text=HARD)
def test_piece_counts(counters, pieces_model, text):
    assert [c.count(text) for c in counters] == [len(pieces_model.encode(text))] * 3


def test_piece_counts_of_huge_texts(counters, pieces_model, prose):
    for text in (prose(1, 9000), "ab" * 40000, "日" * 40000, " " * 40000, "x\n" * 30000):
        assert counters[0].count(text) == len(pieces_model.encode(text))
    assert counters[0].widened  # texts without a stable boundary make overlaps grow


def test_piece_rows(documents):
    df = documents(["é b", None, ""])
    rows = piece_counts.with_token_counts(df, PIECES, 1).collect()
    assert [(r["n_bytes"], r["over_limit"]) for r in rows] == [(4, True), (0, False), (0, False)]
    assert [r["n_tokens"] for r in rows][1:] == [0, 0] and piece_counts.with_token_counts(df.filter("false"), PIECES, 1).count() == 0


def hits_by_definition(text, items):
    words, hit, found = words_by_definition(text), set(), set()
    for item, wanted in items:
        wanted = words_by_definition(wanted)
        n = min(13, len(wanted))
        windows = {tuple(wanted[i : i + n]) for i in range(len(wanted) - n + 1)} if n else set()
        for at in range(len(words) - n + 1):
            if tuple(words[at : at + n]) in windows:
                hit.update(range(at, at + n))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_contamination(spark, documents, prose):
    items = [(1, prose(1, 20)), (20, prose(2, 13)), (3, "two words"), (4, "Short one here"), (5, None), (6, "..."), (7, "word"), (8, prose(1, 20))]
    items.append((9, " ".join(["same"] * 15)))
    one = words_by_definition(items[0][1])
    texts = [
        items[0][1].upper() + " x " * 50, prose(3, 30) + " " + " ".join(one[3:16]) + " end", " ".join(one[:12]), "two; words",
        "a short-one HERE and two words", "word", "Word word", None, "", " ".join(["same"] * 40), prose(4, 400) + " two words",
        items[1][1] + " " + items[0][1], "two", prose(1, 20)[:-1],
    ]
    df = documents([*texts, texts[0]], [*range(len(texts)), 0])
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, n int")
    found = {r["id"]: r for r in decontaminate.contamination(df, benchmark).collect()}
    assert len(found) == len(texts) and found[0]["n_rows"] == 2
    for i, text in enumerate(texts):
        assert (found[i]["n_words"], found[i]["n_hit"], found[i]["items"]) == hits_by_definition(text, items), text
    left = decontaminate.remove_contaminated(df, benchmark)
    clean = [i for i, t in enumerate(texts) if not (h := hits_by_definition(t, items))[1] or 20 * h[1] < h[0]]
    assert sorted(r["doc_id"] for r in left.collect()) == clean and left.columns == df.columns
    assert decontaminate.contamination(df, benchmark.filter("false")).filter("n_hit > 0").count() == 0
    assert decontaminate.contamination(df.filter("false"), benchmark).count() == 0


def test_kneser_ney(documents, prose):
    texts = [prose(i % 7, 80) + " The end" for i in range(30)] + ["the THE the", None, "", "unseen-words only " + "w" * 500]
    df = documents([*texts, texts[0]], [*range(len(texts)), None])
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10
    found = kneser_ney.with_scores(df, part != 0).filter("doc_id IS NOT NULL").collect()
    tokens = [re.findall("[^\x20\x09-\x0d]+", (t or "").translate(UPPER)) + ["\n"] for t in texts]
    trained = [t for i, t in enumerate(tokens) if zlib.crc32(str(i).encode()) % 10]
    count, pairs = Counter(w for t in trained for w in t), Counter()
    for t in trained:
        pairs.update(zip([" ", *t[:-1]], t, strict=True))
    seen, before, kinds = Counter(), Counter(), {1: Counter(), 2: Counter(), 3: Counter()}
    for (u, v), n in pairs.items():
        seen[u] += n
        before[v] += 1
        kinds[min(n, 3)][u] += 1
    by_pair, by_word = Counter(pairs.values()), Counter(before.values())
    d = [0, *kneser_ney.discounts(*[by_pair[k] for k in (1, 2, 3, 4)])]
    e = [0, *kneser_ney.discounts(*[by_word[k] for k in (1, 2, 3, 4)])]
    rest = sum(e[min(n, 3)] for n in before.values()) / len(pairs)
    total, kinds_of_words = sum(count.values()), len(count)

    def lower(v):
        return max(before[v] - e[min(before[v], 3)], 0) / len(pairs) + rest / (kinds_of_words + 1)

    def p(u, v):
        if not seen[u]:
            return lower(v)
        left = sum(d[k] * kinds[k][u] for k in kinds)
        return (max(pairs[u, v] - d[min(pairs[u, v], 3)], 0) + left * lower(v)) / seen[u]

    assert abs(sum(p("the", v) for v in count) + p("the", "never") - 1) < 1e-9
    assert len(found) == len(texts)
    for row in found:
        own, lm = tokens[row["doc_id"]], row["lm"]
        assert (lm["n_tokens"], lm["n_known"], lm["train_tokens"]) == (len(own), sum(count[w] > 0 for w in own), total)
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds_of_words + 1))) for w in own)
        score = sum(math.log10(p(u, v)) for u, v in zip([" ", *own[:-1]], own, strict=True))
        assert lm["base_score"] == pytest.approx(base) and lm["score"] == pytest.approx(score)


def test_kneser_ney_shards_follow_the_text(documents, prose, monkeypatch):
    """More text has more shards, whatever the shuffle partitions, and the scores are the same."""
    df = documents([prose(n, 60) for n in range(8)])

    def scores():
        return {r["doc_id"]: tuple(r["lm"]) for r in kneser_ney.with_scores(df, F.lit(True)).collect()}

    few = scores()
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 100)
    size = df.agg(F.sum(F.octet_length("text"))).first()[0]
    assert kneser_ney.learn(df.select("text")).shards == -(-size // 100) > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = scores()
    assert few.keys() == many.keys() and all(many[k] == pytest.approx(few[k]) for k in few)


def test_kneser_ney_without_training_rows(documents):
    rows = kneser_ney.with_scores(documents(["a b", None]), F.lit(False)).collect()
    assert [(r["lm"]["n_known"], r["lm"]["train_tokens"]) for r in rows] == [(0, 0), (0, 0)]
    assert all(np.isfinite([r["lm"]["base_score"], r["lm"]["score"]]).all() for r in rows)
    assert kneser_ney.with_scores(documents(["a"]).filter("false"), F.lit(True)).count() == 0


def test_packed_counts():
    counts = np.array([1, 254, 255, 256, 70000, 3])
    data = memoryview(kneser_ney._pack_counts(counts) + b"rest")
    got, size = kneser_ney._unpack_counts(data, 6)
    assert got.tolist() == counts.tolist() and bytes(data[size:]) == b"rest"


@pytest.fixture(scope="module")
def labelled(spark, documents, prose):
    texts = [prose(i, 30 + i % 40) for i in range(240)]
    texts = [t if i % 6 else t.upper().replace(" ", "!! ") for i, t in enumerate(texts)]
    labels = spark.createDataFrame([(i, int(i % 6 > 0), 0) for i in range(240)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    return documents([*texts, None, ""]), labels


def test_quality(labelled):
    df, labels = labelled
    wanted = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    scored = df.withColumn("score", quality.quality_score(df, labels, wanted))
    rows = {r["doc_id"]: r["score"] for r in scored.collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((rows[i] >= 0.5) == (i % 6 > 0) for i in held) and len(held) > 30
    assert all(0 <= s <= 1 for s in rows.values()) and rows[240] == rows[241]
    none = df.withColumn("score", quality.quality_score(df, labels.filter("false"), wanted))
    assert {r["score"] for r in none.collect()} == {0.5}


def test_quality_network_is_calibrated_and_repeatable():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 5))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    net, again = quality.train(x[:3000], y[:3000]), quality.train(x[:3000], y[:3000])
    p = net.probabilities(x[3000:])
    assert (p == again.probabilities(x[3000:])).all() and quality.train(x[:0], y[:0]) is None
    assert abs(p.mean() - y[3000:].mean()) < 0.05
    assert quality._loss(net.logits(x[3000:]), y[3000:], net.temperature) < 0.6


def test_pipeline(spark, labelled, prose, tmp_path):
    """Every stage against brute force on what the stage before it kept."""
    df, labels = labelled
    base = prose(77, 120)
    near = base.split()
    near[50] = "changed"
    item = prose(78, 30)
    more = [(1000, base), (1001, base + " "), (1002, " ".join(near)), (1003, item + " " + prose(79, 60)), (1004, prose(79, 500))]
    rows = df.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    rows = rows.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == rows.columns
        kept.append({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
    good, exact, distinct, clean = kept
    assert all(i in good for i in range(240) if i % 6) and sum(i % 6 == 0 for i in good if i < 240) <= 2
    longest = {}
    for i, t in sorted(good.items()):
        key = re.sub("[ \t-\r]", "", t or "")
        if key not in longest or len(t or "") > len(good[longest[key]] or ""):
            longest[key] = i
    assert set(exact) == set(longest.values()) and 1001 in exact and 1000 not in exact
    order = sorted(exact)
    classes = classes_by_definition([exact[i] for i in order])
    assert set(distinct) == {order[c] for c in classes} and 1002 not in distinct
    items = [(1, item)]
    bad = {i for i, t in distinct.items() if (h := hits_by_definition(t, items))[1] and 20 * h[1] >= h[0]}
    assert set(clean) == set(distinct) - bad and bad == {1003}
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in last.collect()} == set(clean)


def test_pipeline_of_odd_rows(spark, labelled, prose, tmp_path):
    """NULL ids and texts, repeated rows, empty texts and columns named like the operators' own; then an empty table."""
    df, labels = labelled
    odd = [(None, None), (None, prose(5, 40)), (7000, None), (7001, ""), (7002, "..."), (7003, prose(6, 40)), (7003, prose(6, 40))]
    rows = df.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = rows.withColumns({name: F.lit(name) for name in ("id", "row", "text_key", "keep_id", "score", "own", "bpe", "kept")})
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(8, 20)), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/documents.parquet").filter("false")):
        before = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == rows.columns
            after = docs.count()
            assert after <= before
            before = after
        last = corpus_pipeline.encode(spark, docs, str(tmp_path))
        assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == before
    once = exact_dedup.keep_one(spark.createDataFrame(odd, "doc_id long, text string"))
    assert sorted(r["text"] or "" for r in once.collect()) == sorted(["", "...", prose(5, 40), prose(6, 40)])


def test_archives_have_a_task_a_shard(spark):
    rows = spark.range(40).select(F.col("id").cast("int").alias("shard")).repartitionById(40, F.col("shard"))
    assert rows.select(F.spark_partition_id().alias("p"), "shard").filter("p <> shard").count() == 0

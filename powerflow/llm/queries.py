"""The operators applied to the whole given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from powerflow.llm import byte_bpe, conversation, decontaminate, exact_dedup, html_text, importance, kneser_ney, near_dedup, packing, piece_counts, quality, url_filter, warc
from powerflow.llm.common import crc_part, table
from powerflow.llm.shared_files import new_folder

BYTE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PACK_VOCABULARY = "byte_bpe_50k.json"
PACK_TOKENS = 2048
PIECE_VOCABULARY = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
QUALITY_FOLDS = 5
LM_FOLDS = 10
QUALITY_THRESHOLD = 0.3
DAMAGE_PARTS = 20
DRAW_BUCKETS = 10_000
DRAW_PERCENT = 10
DRAW_MIN_WORDS = 20
DRAW_SEED = 2024
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    found = decontaminate.contamination(documents, benchmark)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("copy"),
    ).drop("copy")


def quality_column(spark: SparkSession, documents: DataFrame, sf_dir: str) -> Column:
    """Score over the documents' texts, learned from labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    wanted = crc_part(F.col("doc_id"), QUALITY_FOLDS) != 0
    return quality.quality_score(documents, labels, wanted)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = documents.withColumn("score", quality_column(spark, documents, sf_dir))
    return scored.select(
        "doc_id", (crc_part(F.col("doc_id"), QUALITY_FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(PIECE_VOCABULARY)
    return piece_counts.with_token_counts(documents, path, TOKEN_LIMIT).drop("text")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_text.extract(table(spark, sf_dir, "pages"))
    return extracted.select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(BYTE_VOCABULARY)
    coded = byte_bpe.round_trip(documents, path, public_tokenizers.PATTERN, memory=2)
    return coded.select("doc_id", F.col("bpe.n_tokens"), F.col("bpe.ids_sha256"), F.col("bpe.decoded_sha256"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = crc_part(F.col("doc_id"), LM_FOLDS)
    return kneser_ney.with_scores(documents, part != 0).select(
        "doc_id", (part == 0).alias("held_out"), "lm.n_tokens", "lm.n_known", "lm.train_tokens", "lm.base_score", "lm.score"
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation.with_damage(table(spark, sf_dir, "conversations"), DAMAGE_PARTS)
    report = conversation.reports(conversation.edited_turns(damaged, gone=F.col("gone")))
    return report.withColumn("conv_id", F.col("conv").cast("long")).drop("conv")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    drawn = importance.draw(documents, benchmark, DRAW_PERCENT, DRAW_MIN_WORDS, DRAW_SEED, buckets=DRAW_BUCKETS)
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(PACK_VOCABULARY)
    return packing.pack(table(spark, sf_dir, "documents"), path, PACK_TOKENS).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_token_counts": op3_token_counts,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_html_text": op6_html_text,
    "op7_near_dedup": op7_near_dedup,
    "op8_warc": op8_warc,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_lm_scores": op10_lm_scores,
    "op11_conversations": op11_conversations,
    "op12_importance": op12_importance,
    "op13_packing": op13_packing,
}

_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# CRC-32 of the bytes of a text: the table of its 256 remainders, and a step for each byte of the text in hex
_CRC_TABLE = """SELECT list(list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v) ORDER BY v) AS t FROM range(256) AS _(v)"""


def _crc32(text: str, table: str) -> str:
    pairs = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce({pairs}, lambda c, b: xor(c >> 8, {table}[1 + (xor(c, b) & 255)]), 4294967295), 4294967295)"


def _cheapest(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _before(cost: str, edit: str, rest: str, row: str | None = None) -> str:
    """A repair with one more edit in front: its cost, its edits and its rows."""
    rows = f"{rest}.rows" if row is None else f"{row} || CASE WHEN {rest}.rows = '' THEN '' ELSE chr(10) || {rest}.rows END"
    return f"{{'cost': {cost} + {rest}.cost, 'edits': '{edit}' || {rest}.edits, 'rows': {rows}}}"


def _conversation_sql() -> str:
    """A recursion from each conversation's last row to its first, with the best repair of what follows each state."""
    then = {0: 2, 1: 2, 2: 3, 3: 2}  # the state after the turn that comes next
    role = {0: "user", 1: "user", 2: "assistant", 3: "user"}
    keep = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    never = "{'cost': 1000000000, 'edits': '', 'rows': ''}"
    plain = []
    for s in range(4):
        kept = "".join(
            f" WHEN first = '{i}' THEN {_before('more', 'K', f'w{t}', 'role || chr(58) || text')}" for i, t in keep[s].items()
        )
        given = _before("2 + more", "R", f"w{then[s]}", f"'{role[s]}:' || text")
        plain.append(_cheapest(
            _before("3", "D", f"w{s}"),
            f"CASE WHEN must THEN {never}{kept} ELSE {never} END",
            f"CASE WHEN must THEN {never} ELSE {given} END",
        ) + f" AS b{s}")
    best = []
    for s in range(4):
        one = _before("2", "I", f"b{then[s]}", f"'{role[s]}:'")
        inner = _before("2", "I", f"b{then[then[s]]}", f"'{role[then[s]]}:'")
        two = f"(SELECT {_before('2', 'I', 'x', f"'{role[s]}:'")} FROM (SELECT {inner} AS x))"
        best.append(_cheapest(f"b{s}", one, two) + f" AS w{s}")
    end = ", ".join(
        f"{{'cost': {cost}, 'edits': '{edits}', 'rows': {rows}}} AS w{s}"
        for s, (cost, edits, rows) in enumerate([
            (0, "", "''"), (4, "II", "'user:' || chr(10) || 'assistant:'"), (2, "I", "'assistant:'"), (0, "", "''")
        ])
    )
    space = conversation.BLANKS
    return f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations
),
parted AS (SELECT n.*, {_crc32("name", "t")} % {DAMAGE_PARTS} AS part FROM named n, crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN part = 1 THEN '' WHEN part = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM parted, range(CASE WHEN part = 3 THEN 2 ELSE 1 END) WHERE part <> 0
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged
),
judged AS (
    SELECT *, left(role, 1) AS first,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS place,
        CASE WHEN rtrim(text, '{space}') = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
            WHEN right(rtrim(text, '{space}'), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
    FROM numbered
),
paired AS (SELECT *, lag(first) OVER (PARTITION BY conv_id ORDER BY place) || first AS pair FROM judged),
counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au') OR place > 1 AND pair IS NULL) AS illegal
    FROM paired GROUP BY conv_id
),
best AS (
    SELECT conv_id, n AS place, {end} FROM counted
    UNION ALL
    SELECT conv_id, place - 1, {", ".join(best)}
    FROM (
        SELECT b.conv_id, b.place, {", ".join(plain)}
        FROM (
            SELECT best.*, j.role, j.text, j.first, CAST(j.fault = 'truncated' AS INTEGER) AS more,
                j.fault IN ('blank', 'duplicate') AS must
            FROM best JOIN judged j ON j.conv_id IS NOT DISTINCT FROM best.conv_id AND j.place = best.place
        ) b
    )
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(w0.cost AS BIGINT), 0) AS cost,
    coalesce(w0.edits, '') AS audit, sha256(coalesce(w0.rows, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM i.conv_id AND b.place = 0
"""


ORACLES = {
    "op1_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
iw AS (
    SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS win
    FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)
),
dw AS (
    SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS win
    FROM (
        SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n
    )
),
hits AS (SELECT r, s, dw.n, item FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
n_hit AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r
),
n_items AS (
    SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
    FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n_hit USING (r) LEFT JOIN n_items USING (r)
""",
    "op4_exact_dedup": r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
        regexp_replace(coalesce(text, ''), '[ \t-\r]', '', 'g') AS bare
    FROM documents
)
SELECT doc_id,
    first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY bare) AS group_size,
    row_number() OVER w = 1 AS kept,
    sha256(bare) AS text_sha256
FROM d WINDOW w AS (PARTITION BY bare ORDER BY length(t) DESC, doc_id, r)
""",
    "op8_warc": """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
),
k AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest, n) END AS keep FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
    CASE WHEN keep IS NOT NULL AND keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM k
""",
    "op11_conversations": _conversation_sql(),
    "op12_importance": f"""
WITH crc AS ({_CRC_TABLE}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT r, unnest(w) AS word FROM d),
bw AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
placed AS (
    SELECT word, {_crc32("word", "t")} % {DRAW_BUCKETS} AS bucket
    FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc
),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN placed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN placed USING (word) GROUP BY bucket),
gain AS (
    SELECT b AS bucket, floor(1000 * ln(
        (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {DRAW_BUCKETS})::DOUBLE
        / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {DRAW_BUCKETS})::DOUBLE)
    )) AS g
    FROM range({DRAW_BUCKETS}) AS _(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b
),
weighed AS (
    SELECT r, floor(sum(g) / count(*)) AS weight FROM dw JOIN placed USING (word) JOIN gain USING (bucket) GROUP BY r
),
scored AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((
            ('0x' || left(sha256('{DRAW_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8))::BIGINT + 0.5::DOUBLE
        ) / 4294967296::DOUBLE))) AS BIGINT) AS score,
        len(w) >= {DRAW_MIN_WORDS} AS eligible
    FROM d LEFT JOIN weighed USING (r)
),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS FIRST) AS place,
        count(*) OVER (PARTITION BY eligible) AS n
    FROM scored
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN eligible AND place <= {DRAW_PERCENT} * n // 100 THEN place END AS rank
FROM ordered
""",
}

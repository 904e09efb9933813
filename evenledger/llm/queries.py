"""The operators over their whole tables, with production parameters, and their SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, md5_number(unnest(s)) AS g FROM sets),
ranked AS (SELECT doc_id, n, g, row_number() OVER (PARTITION BY doc_id ORDER BY f, g) AS pos FROM items JOIN (SELECT g, count(*) AS f FROM items GROUP BY g) USING (g)),
prefix AS (SELECT doc_id, n, g FROM ranked WHERE pos <= n - ceil(n * 0.8) + 1),
pairs AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM prefix a JOIN prefix b ON a.g = b.g AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80),
met AS (SELECT p.a, p.b, count(*) AS hits FROM pairs p JOIN items x ON x.doc_id = p.a JOIN items y ON y.doc_id = p.b AND y.g = x.g GROUP BY p.a, p.b),
links AS (SELECT m.a, m.b FROM met m JOIN sets x ON x.doc_id = m.a JOIN sets y ON y.doc_id = m.b WHERE hits * 100 >= 80 * (len(x.s) + len(y.s) - hits)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT node, min(root) AS component_id FROM reach GROUP BY node) c ON c.node = s.doc_id
"""
)
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evenledger.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def _digest(buf, removed):
    import hashlib

    from evenledger.llm.suffix import whole_characters

    starts = int(removed[:1].sum()) + int((removed[1:] & ~removed[:-1]).sum())
    kept = hashlib.sha256(buf[~removed].tobytes()).hexdigest()
    return len(buf), int(removed.sum()), starts, kept, whole_characters(buf, removed)


@query()
def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from functools import partial

    from evenledger.llm.suffix import cut_batches, with_spans

    rows = with_spans(table(spark, sf_dir, "documents"), length=400)
    found = rows.mapInArrow(partial(cut_batches, digest=_digest), "doc_id long, c0 long, c1 long, c2 long, c3 string, c4 string")
    return found.toDF("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")


@query(
    """
WITH split AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
on_page AS (SELECT doc_id, source, unnest(list_distinct(list_transform(lines, lambda x: trim(x)))) AS line FROM split),
bad AS (SELECT o.source, o.line FROM on_page o JOIN pages p ON p.source IS NOT DISTINCT FROM o.source
  WHERE o.line <> '' GROUP BY o.source, o.line, p.pages HAVING count(*) >= 3 AND count(*) * 100 > p.pages * 10),
listed AS (SELECT source, list(line) AS bad FROM bad GROUP BY source),
kept AS (SELECT s.doc_id, s.lines, CASE WHEN l.bad IS NULL THEN s.lines ELSE list_filter(s.lines, lambda x: NOT list_contains(l.bad, trim(x))) END AS kept
  FROM split s LEFT JOIN listed l ON l.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped, md5(array_to_string(kept, chr(10))) AS kept_md5 FROM kept
"""
)
def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from evenledger.llm.lines import drop_boilerplate

    found = drop_boilerplate(table(spark, sf_dir, "documents"), percent=10, min_pages=3)
    return found.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("kept_md5"))


@query()
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evenledger.llm.common import held_out
    from evenledger.llm.mixing import score_texts

    return score_texts(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _token_digest(vocab, doc_ids, tokens, bounds):
    import hashlib

    import pyarrow as pa

    from evenledger.llm.bpe import decoded

    ids, texts = [], []
    for a, b in zip(bounds[:-1], bounds[1:]):
        ids.append(hashlib.sha256(tokens[a:b].astype("<u4").tobytes()).hexdigest())
        texts.append(hashlib.sha256(decoded(vocab, tokens[a:b])).hexdigest())
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array(bounds[1:] - bounds[:-1]), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


@query()
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evenledger.llm.bpe import encode

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode(table(spark, sf_dir, "documents"), tokenizer_path(), _token_digest, schema)


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evenledger.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end=0)


@query()
def op3_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from evenledger.llm.common import held_out
    from evenledger.llm.toxicity import fit, score_texts

    docs = table(spark, sf_dir, "documents")
    held = held_out("doc_id", 5, 0)
    found = score_texts(docs, fit(docs, table(spark, sf_dir, "labels"), learn_from=~held))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op2_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evenledger.llm.htmltext import extract

    return extract(table(spark, sf_dir, "pages"), keep="url").select("page_id", "url", "text", "n_chars")


@query()
def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evenledger.llm.hnsw import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


@query()
def op7_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from evenledger.llm.forest import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query(
    r"""
WITH RECURSIVE coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    (xor(list_reduce(list_transform(string_split(concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda acc, b: list_reduce([CAST(k AS BIGINT) FOR k IN range(8)], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(acc, b)), CAST(4294967295 AS BIGINT)), 4294967295)) % 20 AS h
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM coded)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid, left(role, 1) AS c FROM damaged),
marked AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c NOT IN ('su', 'ua', 'au') AS clash FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (clash) AS illegal, count(*) AS n
  FROM marked GROUP BY conv_id),
everyone AS (SELECT DISTINCT conv_id FROM conversations),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {'c': CAST(0 AS BIGINT), 'w': ''} AS v0, {'c': CAST(1000000 AS BIGINT), 'w': ''} AS v1,
    {'c': CAST(2 AS BIGINT), 'w': 'I'} AS v2, {'c': CAST(4 AS BIGINT), 'w': 'II'} AS v3 FROM everyone
  UNION ALL
  SELECT conv_id, i, n0, n1,
    list_min([n2, {'c': n0.c + 2, 'w': n0.w || 'I'}, {'c': n1.c + 2, 'w': n1.w || 'I'}, {'c': n3.c + 2, 'w': n3.w || 'I'}]),
    list_min([n3, {'c': n2.c + 2, 'w': n2.w || 'I'}, {'c': n0.c + 4, 'w': n0.w || 'II'}, {'c': n1.c + 4, 'w': n1.w || 'II'}])
  FROM (
    SELECT s.conv_id, m.i,
      {'c': v0.c + 3, 'w': v0.w || 'D'} AS n0,
      list_min([{'c': v1.c + 3, 'w': v1.w || 'D'}, {'c': v0.c + stay + if(m.c = 's', 0, 1000000), 'w': v0.w || 'K'}]) AS n1,
      list_min([{'c': v2.c + 3, 'w': v2.w || 'D'},
        {'c': v0.c + stay + if(m.c = 'u', 0, 2), 'w': v0.w || if(m.c = 'u', 'K', 'R')},
        {'c': v1.c + stay + if(m.c = 'u', 0, 2), 'w': v1.w || if(m.c = 'u', 'K', 'R')},
        {'c': v3.c + stay + if(m.c = 'u', 0, 2), 'w': v3.w || if(m.c = 'u', 'K', 'R')}]) AS n2,
      list_min([{'c': v3.c + 3, 'w': v3.w || 'D'}, {'c': v2.c + stay + if(m.c = 'a', 0, 2), 'w': v2.w || if(m.c = 'a', 'K', 'R')}]) AS n3
    FROM steps s JOIN (SELECT *, CASE fault WHEN 'truncated' THEN 1 WHEN '' THEN 0 ELSE 1000000 END AS stay FROM marked) m
      ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.i = s.i + 1)),
ended AS (
  SELECT s.conv_id, list_min([v0, v3]) AS best FROM steps s LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id WHERE s.i = coalesce(c.n, 0)),
letters AS (
  SELECT conv_id, best.w AS audit, unnest(range(1, length(best.w) + 1)) AS k, substr(best.w, k, 1) AS e FROM ended),
edits AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i, count(*) FILTER (e <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS o,
    count(*) FILTER (e <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd FROM letters),
lines AS (
  SELECT e.conv_id, string_agg(CASE WHEN e.e = 'K' THEN m.role WHEN (e.o - e.odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || if(e.e = 'I', '', m.text), chr(10) ORDER BY e.k) AS t
  FROM edits e LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.i = e.i WHERE e.e <> 'D' GROUP BY e.conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.c AS cost, best.w AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM ended a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM a.conv_id
"""
)
def op13_auction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evenledger.llm.conversations import repair

    return repair(damaged(table(spark, sf_dir, "conversations")), present="here", copies="copies")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the crc32 of ``conv_id:turn``; a dropped row stays with ``here`` false."""
    from pyspark.sql import functions as F

    def spaced(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), spaced("conv_id").alias("c"), spaced("turn").alias("t"))
    h = F.crc32(F.concat("c", F.lit(":"), "t").cast("binary")) % 20
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(h == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (h != 0).alias("here"), F.when(h == 3, 2).otherwise(1).cast("long").alias("copies"))


def repeat_tail(doc_id, words):
    """The words with a periodic tail where the crc32 of the id is divisible by 10; those of a null id stay."""
    import zlib

    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


@query()
def op11_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from evenledger.llm.runs import periodic_runs

    found = periodic_runs(table(spark, sf_dir, "documents"), least=12, rewrite=repeat_tail)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.withColumn("best", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query()
def op12_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evenledger.llm.common import held_out
    from evenledger.llm.language import fit, identify

    docs = table(spark, sf_dir, "documents")
    held = held_out("doc_id", 3, 1)
    found = identify(docs, fit(docs, piece_path(), learn_from=~held), piece_path())
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")

"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .bit_slices import top_k
from .decontaminate import decontaminate
from .html_text import extract_text, fit_weights
from .jaccard import similar_documents
from .packing import pack
from .resampling import resample
from .sanitise import KINDS, find_personal_data, span_text
from .substrings import remove_repeats
from .token_files import read_token_files, write_token_files
from .toxicity import fit_lexicon, score_toxicity
from .turn_repair import edit_log, mark_turns, repair_turns, structure
from .url_rules import judge_urls
from .vectors import near_vectors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query(
    "op9_url_filters",
    """
    WITH parsed AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), split AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM parsed
    ), rules(rule, rule_host, rule_path, action) AS (
        VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
               ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
    ), fitting AS (
        SELECT s.host, s.path, r.rule, r.action,
               row_number() OVER (PARTITION BY s.host, s.path ORDER BY length(r.rule) DESC, length(r.rule_host) DESC, r.rule DESC) AS place
        FROM (SELECT DISTINCT host, path FROM split) s
        JOIN rules r ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)
    )
    SELECT page_id, s.host, s.path, f.rule, coalesce(f.action, 'allow') AS verdict
    FROM split s LEFT JOIN fitting f ON f.place = 1 AND f.host = s.host AND f.path = s.path
    """,
)
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, action string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@query(
    "op10_benchmark_decontamination",
    r"""
    WITH doc_words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ), item_words AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
    ), item_windows AS (
        SELECT DISTINCT item_id, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win, least(10, len(w)) AS n
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)
    ), doc_windows AS (
        SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
    ), found AS (
        SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (win, n)
    ), hits AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id
    ), items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
    FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
    """,
)
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate(docs, table(spark, sf_dir, "benchmark"), clean=False)
    return marked.selectExpr("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "n_hit > 0 AS contaminated")


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids; the rest of each merged group is cut into powers of two, so nothing is padded."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack(docs, public_tokenizers.path("word_bpe_49k.json"), "dropped", end_id=1, keep=["doc_id"], with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit_lexicon(docs, training_labels(table(spark, sf_dir, "labels"))))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"), "n_hits")


#: Score from which a document counts as toxic.
TOXIC_SCORE = 0.3


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: the checksum of the key, modulo 4, is not 2."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select("doc_id", "toxic")


@query("op6_html_extraction")
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages, fit_weights(pages)).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = span_text(F.filter("spans", lambda s: s["kind"] != "term"))
    return found.select("doc_id", *map(number, KINDS), F.sha2(base, 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


@query("op5_ngram_jaccard")
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_substring_dedup")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op4_embedding_near_dedup")
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.path("byte_bpe_50k.json"), "kept", end_id=2)
    return read_token_files(spark, path, with_ids=False).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


#: SQL tables with what the checksum of one byte adds (``crc_table``), by its rule.
CRC_TABLE = """
    crc_table AS (
        SELECT list(v ORDER BY n) AS crc_of
        FROM (SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) r(n))
    )"""


def crc_sql(column: str) -> str:
    """Checksum of a text's bytes, next to ``crc_table``."""
    octets = f"list_transform(range(octet_length(encode({column}))), lambda i: CAST('0x' || substr(hex(encode({column})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295)"


@query(
    "op13_importance_resampling",
    rf"""
    WITH {CRC_TABLE}, doc_words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ), item_words AS (
        SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
    ), s_words AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM doc_words) GROUP BY word),
    t_words AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM item_words) GROUP BY word),
    hashed AS (
        SELECT word, {crc_sql("word")} % 10000 AS bucket FROM (SELECT word FROM s_words UNION SELECT word FROM t_words), crc_table
    ), counted AS (
        SELECT bucket, sum(s) AS s, sum(t) AS t
        FROM (SELECT bucket, n AS s, 0 AS t FROM s_words JOIN hashed USING (word) UNION ALL SELECT bucket, 0, n FROM t_words JOIN hashed USING (word)) GROUP BY bucket
    ), gains AS (
        SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * ((SELECT coalesce(sum(n), 0) FROM s_words) + 10000.0::DOUBLE)
                   / ((CAST(s AS DOUBLE) + 1) * ((SELECT coalesce(sum(n), 0) FROM t_words) + 10000.0::DOUBLE)))) AS BIGINT) AS gain FROM counted
    ), weights AS (
        SELECT doc_id, sum(gain) AS weight FROM (SELECT doc_id, unnest(w) AS word FROM doc_words) JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
    ), scored AS (
        SELECT doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
               CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
        FROM doc_words LEFT JOIN weights USING (doc_id)
    ), noisy AS (
        SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM scored
    ), placed AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM noisy WHERE n_features >= 20
    )
    SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
    FROM noisy LEFT JOIN placed USING (doc_id)
    """,
)
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query(
    "op12_exact_top_k",
    """
    WITH usable AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
    ), placed AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 20
    """,
)
def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults planted by the checksum of conversation and turn; a missing value counts as one space."""
    named = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    rows = conversations.select("conv_id", "turn", named("role").alias("role"), named("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    rows = rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def joined_digest(log: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of what an edit log leaves of each conversation; lines stream through, none is held."""
    kind = log.schema["conv"].dataType.simpleString()
    lines = log.where("edit <> 'D'").select("conv", "place", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv").sortWithinPartitions("conv", "place", "step").select("conv", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, digest = None, None
        for batch in batches:
            names, digests = [], []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if digest is None or conv != open_:
                    if digest is not None:
                        names.append(open_)
                        digests.append(digest.hexdigest())
                    open_, digest = conv, hashlib.sha256(line.encode())
                else:
                    digest.update(b"\n" + line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, batch.schema.field(0).type), pa.array(digests, pa.string())], ["conv", "repaired_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_], batch.schema.field(0).type), pa.array([digest.hexdigest()])], ["conv", "repaired_sha256"])

    return lines.mapInArrow(run, f"conv {kind}, repaired_sha256 string")


@query(
    "op11_conversation_repair",
    rf"""
    WITH RECURSIVE {CRC_TABLE}, keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
    ), hit AS (
        SELECT conv_id, turn, role, text, {crc_sql("key")} % 20 AS kind FROM keyed, crc_table
    ), rows_ AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM hit WHERE kind <> 0
    ), placed AS (
        SELECT conv_id, turn, role, text, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text), copy) AS i,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
        FROM rows_
    ), marked AS (
        SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
               left(role, 1) AS kind, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
        FROM placed
    ), moves(state, pre, letters, added, paid) AS (
        VALUES (0, 0, '', CAST([] AS VARCHAR[]), 0), (0, 2, 'I', ['user:'], 3), (0, 3, 'II', ['user:', 'assistant:'], 6),
               (1, 1, '', [], 0), (1, 2, 'I', ['user:'], 3), (1, 3, 'II', ['user:', 'assistant:'], 6),
               (2, 2, '', [], 0), (2, 3, 'I', ['assistant:'], 3), (2, 2, 'II', ['assistant:', 'user:'], 6),
               (3, 3, '', [], 0), (3, 2, 'I', ['user:'], 3), (3, 3, 'II', ['user:', 'assistant:'], 6)
    ), edits(letter, price, kinds, before, after) AS (
        VALUES ('D', 4, NULL, 0, 0), ('D', 4, NULL, 1, 1), ('D', 4, NULL, 2, 2), ('D', 4, NULL, 3, 3),
               ('R', 3, NULL, 0, 2), ('R', 3, NULL, 1, 2), ('R', 3, NULL, 2, 3), ('R', 3, NULL, 3, 2),
               ('K', 0, 's', 0, 1), ('K', 0, 'u', 0, 2), ('K', 0, 'u', 1, 2), ('K', 0, 'u', 3, 2), ('K', 0, 'a', 2, 3)
    ), paths AS (
        SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM (SELECT DISTINCT conv_id FROM marked)
        UNION ALL
        SELECT conv_id, i, after, cost, audit, lines
        FROM (
            SELECT m.conv_id, m.i, e.after, p.cost + v.paid + e.price + CASE WHEN e.letter <> 'D' AND m.fault = 'truncated' THEN 3 ELSE 0 END AS cost, p.audit || v.letters || e.letter AS audit,
                   list_concat(p.lines, v.added, CASE e.letter WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [m.role || ':' || m.text]
                               ELSE [CASE e.after WHEN 3 THEN 'assistant:' ELSE 'user:' END || m.text] END) AS lines,
                   row_number() OVER (PARTITION BY m.conv_id, e.after ORDER BY p.cost + v.paid + e.price + CASE WHEN e.letter <> 'D' AND m.fault = 'truncated' THEN 3 ELSE 0 END, p.audit || v.letters || e.letter) AS best
            FROM paths p JOIN marked m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1
            JOIN moves v ON v.state = p.state JOIN edits e ON e.before = v.pre
            WHERE (e.kinds IS NULL OR e.kinds = m.kind) AND (e.letter = 'D' OR m.fault IS NULL OR m.fault = 'truncated')
        ) WHERE best = 1
    ), ends(state, letters, added, paid) AS (
        VALUES (0, '', CAST([] AS VARCHAR[]), 0), (1, 'II', ['user:', 'assistant:'], 6), (2, 'I', ['assistant:'], 3), (3, '', [], 0)
    ), facts AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM marked GROUP BY conv_id
    ), finished AS (
        SELECT p.conv_id, p.cost + e.paid AS cost, p.audit || e.letters AS audit, list_concat(p.lines, e.added) AS lines,
               row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + e.paid, p.audit || e.letters) AS best
        FROM paths p JOIN facts f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.i JOIN ends e ON e.state = p.state
    )
    SELECT c.conv_id, CAST(coalesce(f.gaps, 0) AS BIGINT) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
           coalesce(f.illegal, 0) AS illegal, CAST(coalesce(d.cost, 0) AS BIGINT) AS cost, coalesce(d.audit, '') AS audit, sha256(coalesce(array_to_string(d.lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN finished d ON d.best = 1 AND d.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(table(spark, sf_dir, "conversations"))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    rows = damaged(conversations)
    marked = mark_turns(rows)
    solved = repair_turns(marked)
    stretch = F.struct("stretch", F.array_join("edits", "").alias("edits"))
    audits = solved.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"), F.array_sort(F.collect_list(stretch)).alias("all"))
    audits = audits.select("conv", "cost", "illegal", F.array_join(F.transform("all", lambda s: s["edits"]), "").alias("audit"))
    digests = joined_digest(edit_log(rows, marked, solved))
    parts = [conversations.select(F.col("conv_id").alias("conv")).distinct(), structure(marked), audits, digests]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = every.groupBy("conv").agg(*(F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers), *(F.max(c).alias(c) for c in ("audit", "repaired_sha256")))
    return whole.select(
        F.col("conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )

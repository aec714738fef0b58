"""The registered queries of this subpackage, each over its whole table, and their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import language_id, toxicity
from adloom.llm.align import align_corpus
from adloom.llm.bpe import encode_decode, tokenizer_file
from adloom.llm.chat_format import format_chats, parse, unescape
from adloom.llm.common import HELD_OUT, fold_of, table
from adloom.llm.conversation_repair import damage, repair, turn_digests
from adloom.llm.decontaminate import find_leaks, split_items
from adloom.llm.exact_dedup import exact_groups
from adloom.llm.license_scan import license_share, scan_licenses
from adloom.llm.minhash import near_duplicates
from adloom.llm.pii import find_personal
from adloom.llm.url_filter import Rule, judge_urls
from adloom.llm.warc import read_warc, write_warc
from adloom.session import new_table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def sha(text):
    return F.sha2(text, 256)


@query(r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, length(role || text) + length(regexp_replace(role || chr(10) || text, '[^\\]', '', 'g'))
    + len(regexp_extract_all(role || chr(10) || text, '<\||</?s>|\[/?INST\]|<</?SYS>>')) + 33 AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""")
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as records of three layouts, formatted; every digest is read back from the formatted text."""
    probe = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.unionByName(spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], rows.schema))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    t, roles = F.col("t"), F.transform("t", lambda x: x["role"])
    pair = (F.size(t) == 2) & (t[0]["role"] == "user") & (t[1]["role"] == "assistant")
    plain = F.forall(roles, lambda r: r.isin("user", "assistant"))
    as_pair = F.struct(t[0]["text"].alias("prompt"), t[1]["text"].alias("response"))
    as_from = F.struct(F.transform(t, lambda x: F.struct(F.when(x["role"] == "user", "human").otherwise("gpt").alias("from"), x["text"].alias("value"))).alias("conversations"))
    as_messages = F.struct(F.transform(t, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages"))
    record = F.when(pair, F.to_variant_object(as_pair)).when(plain, F.to_variant_object(as_from)).otherwise(F.to_variant_object(as_messages))
    made = format_chats(convs.select("conv_id", record.alias("record")))
    turns = parse(F.col("formatted"))
    loss = F.array_join(F.transform(F.filter(made["segments"], lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    read = made.select("conv_id", "formatted", turns.alias("back"), loss.alias("loss"))
    said = F.array_join(F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), sha(said).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
        sha(F.col("loss")).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query("""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
WINDOW g AS (PARTITION BY norm)
""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query()
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page urls. The number in a path names a document; low quality or toxic documents label their page as bad."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    told = labels.groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    number = F.expr("try_cast(regexp_extract(url, '^[^?#]*?://[^/?#]*[^?#]*/([0-9]+)', 1) AS BIGINT)")
    rows = pages.select("page_id", "url", number.alias("doc_id"))
    has = F.col("doc_id").isNotNull()
    marked = rows.where(has).join(told, "doc_id", "left").select("page_id", "url", "bad")
    marked = marked.unionByName(rows.where(~has).select("page_id", "url", F.lit(None).cast("int").alias("bad")))
    return judge_urls(marked, URL_RULES)


@query()
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as files below source, language and thousand of ids; those whose lines are mostly about licences are the licence files."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("und")), F.expr("doc_id div 1000").cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text", (license_share(F.col("text")) >= 0.5).alias("is_license_file"))
    return scan_licenses(files).withColumnRenamed("file_id", "doc_id")


@query()
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), ("ids_sha256", "decoded_sha256"))


@query()
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("""
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, html, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
""")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages into archives in the shared folder and back; every column is read from the archives."""
    archives = new_table_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").cast("binary").alias("payload")), archives)
    page = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).cast("long")
    got = read_warc(spark, archives)
    return got.select(
        page("record_id").alias("page_id"), "payload_bytes", F.coalesce("real_digest", "digest").alias("payload_digest"), F.col("kind").alias("record_type"),
        F.when(F.col("kind") == "revisit", page("refers_to")).alias("refers_to"),
    )


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = fold_of(F.col("doc_id")) == HELD_OUT
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= model.params.threshold).cast("int"))


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs)
    held_out = fold_of(F.col("doc_id")) == HELD_OUT
    return docs.select("doc_id", held_out.alias("held_out"), language_id.language(F.col("text"), model).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


@query()
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), split_items(table(spark, sf_dir, "benchmark")))


@query()
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; the counts are of the spans as they stand, n_disguised of those that the transducers add."""
    columns = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "span_list", "n_disguised")
    return find_personal(table(spark, sf_dir, "documents"), columns).withColumnRenamed("span_list", "spans")


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return align_corpus(table(spark, sf_dir, "documents"), files, hashed=True).withColumnRenamed("groups", "groups_sha256")


@query()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged, then repaired; one row per conversation that was there before the damage."""
    chats = table(spark, sf_dir, "conversations")
    fixed = repair(damage(chats))
    told = fixed.reports.join(turn_digests(fixed.turns).withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c")), "left").drop("c")
    met = chats.select("conv_id").distinct().join(told, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return met.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", sha(F.lit(""))).alias("repaired_sha256"))

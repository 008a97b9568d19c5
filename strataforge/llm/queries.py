"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataforge.llm import (
    bpe_codec,
    decontaminate,
    license_scan,
    line_dedup,
    near_vectors,
    ngram_join,
    quality,
    spelling,
    surrogates,
    term_search,
    token_counts,
    url_filter,
    vector_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_bpe_codec")
def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_codec.round_trip(docs, vocabulary("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe_codec.ids_digest("ids").alias("ids_sha256"),
        bpe_codec.text_digest("decoded").alias("decoded_sha256"),
    )


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, vocabulary("byte_bpe_50k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit"),
    )


OP3_SQL = """
with lines as (
  select doc_id, pos, string_split(coalesce(text, ''), chr(10))[pos] as line
  from documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as u(pos)
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), common as (
  select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10
)
select doc_id, count(*) as n_lines, count(*) filter (where c.key is not null) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where c.key is null), '')) as kept_sha256
from keyed left join common c using (key)
group by doc_id
"""


@query("op3_line_dedup", OP3_SQL)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_repeated_lines(docs, min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", bpe_codec.text_digest("text").alias("kept_sha256"))


#: The phrases of the contract and their labels.
LICENSE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@query("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.license_scan(docs, LICENSE_PHRASES)
    place = lambda i: F.get("places", F.lit(i))["start"].cast("long")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        place(0).alias("first_word"),
        F.get("places", F.size("places") - 1)["start"].cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("places", lambda x: x["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


#: The rules of the contract.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.url_filter(pages, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


@query("op2_ngram_join")
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), k=4, percent=85)


@query("op7_near_vectors")
def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_scores(docs).select("doc_id", "junk_posterior", "junk_score", "kept")


#: The key of the registered query; a real run brings a secret one.
SURROGATE_KEY = b"strataforge example key"


@query("op9_surrogates")
def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    replaced = surrogates.replace_entities(docs, SURROGATE_KEY)
    return replaced.select("doc_id", "n_entities", F.array_join("kinds", ",").alias("kinds"), "text")


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds as a chain of tables: entries(part, entry, number, pos), nearest entry of each part, floors of means."""
    assign = """
near{r} as materialized (
  select vec_id, part, min(d)[1] as dist, min(d)[2] as entry from (
    select p.vec_id, p.part, [sum((p.x - b.x) * (p.x - b.x)), b.entry] as d
    from cells p join book{r} b using (part, pos) group by p.vec_id, p.part, b.entry
  ) group by vec_id, part
)"""
    update = """
book{n} as materialized (
  select b.part, b.entry, b.pos,
    case when count(p.x) = 0 then any_value(b.x) else (sum(p.x) - ((sum(p.x) % count(p.x)) + count(p.x)) % count(p.x)) // count(p.x) end as x
  from book{r} b left join near{r} a using (part, entry) left join cells p on p.vec_id = a.vec_id and p.part = b.part and p.pos = b.pos
  group by b.part, b.entry, b.pos
)"""
    chain = "".join("," + assign.format(r=r) + "," + update.format(r=r, n=r + 1) for r in range(rounds)) + "," + assign.format(r=rounds)
    return f"""
with kept as materialized (
  select vec_id, label, embedding as v, len(embedding) // {parts} as w from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), cells as materialized (
  select vec_id, (i - 1) // w as part, (i - 1) % w as pos, cast(floor(4096 * cast(v[i] as double)) as hugeint) as x
  from kept, unnest(range(1, len(v) + 1)) as u(i)
), firsts as (
  select vec_id, row_number() over (order by vec_id) - 1 as entry from kept order by vec_id limit {entries}
), book0 as materialized (
  select part, entry, pos, x from cells join firsts using (vec_id)
){chain}, coded as (
  select vec_id, string_agg(printf('%02x', cast(entry as integer)), '' order by part) as code, cast(sum(dist) as bigint) as error
  from near{rounds} group by vec_id
)
select vec_id, label, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(cast(x as varchar), ',' order by part, entry, pos)) from book{rounds}) as codebooks_sha256
from kept join coded using (vec_id)
"""


@query("op11_vector_codes", _codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


OP12_SQL = """
with kept as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from kept q join kept c on q.vec_id != c.vec_id where q.vec_id % 100 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 10
"""


@query("op12_top_k", OP12_SQL)
def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return term_search.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


#: crc32 in SQL: the table of a byte's eight steps, folded over the bytes of each text.
OP13_SQL = """
with recursive steps(b, i, c) as (
  select cast(r as ubigint), 0, cast(r as ubigint) from range(256) u(r)
  union all
  select b, i + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end from steps where i < 8
), crc as materialized (
  select list(c order by b) as tab from steps where i = 8
), runs as (
  select cast(doc_id as varchar) as doc_id,
    unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as raw from documents
), lowered as materialized (
  select doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as m
  from runs where length(raw) >= 7 group by all
), hexed as (
  select *, hex(encode(coalesce(doc_id, '') || ':' || run)) as x from lowered
), hashed as materialized (
  select run, m, xor(list_reduce(
      list_prepend(4294967295::ubigint, list_transform(range(1, len(x) // 2 + 1), lambda i: cast('0x' || substr(x, 2 * i - 1, 2) as ubigint))),
      lambda c, b: xor(c >> 8, list_extract(tab, cast(xor(c, b) & 255 as bigint) + 1))), 4294967295::ubigint) as h
  from hexed, crc
), words as materialized (
  select word, cast(sum(m) as bigint) as n from (
    select m, case when h % 31 = 0 then substr(run, 1, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) as bigint) + 2)
      else run end as word from hashed)
  where length(word) >= 7 group by word having sum(m) >= 2
), less as materialized (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from words, unnest(range(1, length(word) + 1)) as u(i)
), near as materialized (
  select a.word, b.word as other from less a join less b using (i, rest) where a.word != b.word
  union
  select l.word, w.word from less l join words w on w.word = l.rest
  union
  select w.word, l.word from less l join words w on w.word = l.rest
), ranked as (
  select near.word, near.other, o.n as other_n, count(*) over (partition by near.word) as n_near,
    row_number() over (partition by near.word order by o.n desc, encode(near.other)) as place
  from near join words o on o.word = near.other
), formed as materialized (
  select w.word, w.n, coalesce(r.n_near, 0) as n_near,
    case when r.other_n >= 10 * w.n then r.other end as form, case when r.other_n >= 10 * w.n then r.other_n end as form_n
  from words w left join ranked r on r.word = w.word and r.place = 1
), walk(word, last) as (
  select word, form from formed where form is not null
  union all
  select walk.word, f.form from walk join formed f on f.word = walk.last where f.form is not null
), roots as (
  select walk.word, walk.last as root from walk join formed f on f.word = walk.last where f.form is null
)
select word, form, coalesce(root, word) as root, n, n_near, form_n from formed left join roots using (word)
"""


@query("op13_spelling_forms", OP13_SQL)
def op13_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_forms(spelling.corpus_words(docs))

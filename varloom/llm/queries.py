"""The registered queries of the operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm import exact, language, minhash, mixing, neighbours, packing, phrases, pii, quality, resharding, search, secret_scan, warc
from varloom.llm.common import hash_fold, small_batches
from varloom.session import new_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def tokenizer_path() -> str:
    """Place of the vocabulary that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with how many of their words the mix takes."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    mixed = mixing.mix(docs).select("doc_id", "source", "mix.*")
    return mixed.withColumn("taken", F.col("size") * F.col("copies"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found of every twentieth one."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), lambda vec_id: vec_id % 20 == 0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = hash_fold(F.col("doc_id"), 4, 2)
    model = language.train(docs.filter(~held_out))
    told = small_batches(docs).select("doc_id", held_out.alias("held_out"), language.identify(model, F.col("text")).alias("told"))
    return told.select("doc_id", "held_out", "told.lang_pred", "told.score", "told.margin", "told.ambiguous")


#: The layout that the resharding query starts from: the documents lie in 12 shards by a hash.
OLD_SHARDS, SHARDS = 12, 16


def op4_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents moved from 12 shards to 16 of near equal bytes."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    old = F.pmod(F.xxhash64("doc_id", "text"), F.lit(OLD_SHARDS))
    placed, plan = resharding.reshard(docs, old, SHARDS)
    rows = resharding.with_slots(resharding.rewrite(placed, plan))
    return rows.select(
        "doc_id",
        resharding.row_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("new_shard").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data and secrets replaced by surrogates."""
    return pii.replace_personal_data(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels that are not held out."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality").filter(~hash_fold(F.col("doc_id"), 3, 1))
    model = quality.train(docs, labels)
    scored = small_batches(docs).select(
        "doc_id", hash_fold(F.col("doc_id"), 3, 1).alias("held_out"), quality.score(model, F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    path = new_path(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return warc.page_records(spark, path)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 tokens."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path()).drop("raw_hash")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups of documents by their recipes of chunks."""
    return exact.exact_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words belong together most."""
    return phrases.collocations(_table(spark, sf_dir, "documents", "text", "lang"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that rank first for every benchmark item."""
    items = _table(spark, sf_dir, "benchmark", "item_id", "text")
    return search.rank_documents(_table(spark, sf_dir, "documents", "doc_id", "text"), items)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by kind, with their places."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    told = small_batches(docs).select("doc_id", secret_scan.find_secrets(F.col("text")).alias("told"))
    return told.select("doc_id", "told.n_assign", "told.n_access", "told.n_hex", F.sha2("told.base", 256).alias("base_sha256"), "told.spans")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_mixing, op2_neighbours, op3_language_id, op4_resharding, op5_pii, op6_quality, op7_warc, op8_packing, op9_exact_dedup, op10_minhash, op11_phrases, op12_search, op13_secrets)}


_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

OP9_SQL = rf"""
with n as (select doc_id, length(coalesce(text, '')) as len, sha256({_NORM}) as text_sha256 from documents),
r as (
  select doc_id, text_sha256, row_number() over w as place,
    first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size
  from n window w as (partition by text_sha256 order by len desc, doc_id nulls last))
select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from r
"""


OP1_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    cast('0x' || substr(md5('mix-1|' || coalesce(cast(doc_id as varchar), '') || '|' || md5(coalesce(text, ''))), 1, 15) as bigint) as bits
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (
  select *, cast(3 * source_size as double) as cap, sum(source_size) over () as total,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end::double as w
  from s),
f as (
  select *, coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0) as before,
    sum(w) over (o rows between current row and unbounded following) as rest
  from w window o as (order by cap / w, source nulls first)),
c as (select *, cap * rest <= (total - before) * w as clamped from f),
p as (
  select source, source_size, case when clamped then cap
    else (total - coalesce(sum(case when clamped then cap end) over (), 0)) * w / sum(case when not clamped then w end) over () end as target
  from c),
q as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole,
    target - case when source_size > 0 then floor(target / source_size) else 0 end * source_size as need
  from p),
b as (select source, bits, sum(size) as size from d group by source, bits),
r as (
  select b.source, b.bits, q.need > 0 and 2 * sum(b.size) over (partition by b.source order by b.bits) - b.size <= 2 * q.need as more
  from b join q on b.source is not distinct from q.source)
select d.doc_id, d.source, d.size, q.source_size, q.target, q.whole + r.more::bigint as copies, d.size * (q.whole + r.more::bigint) as taken
from d join q on d.source is not distinct from q.source
  join r on d.source is not distinct from r.source and d.bits = r.bits
"""


OP7_SQL = """
with p as (select page_id, sha1(coalesce(html, '')) as h, strlen(coalesce(html, '')) as payload_bytes from pages),
g as (select *, max(page_id) over (partition by h) as largest from p),
b as (
  select *, array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, cast(i * 5 + 1 as int), 5))::int >> s) & 31) + 1, 1)), '')), '') as payload_digest
  from g)
select page_id, payload_bytes, payload_digest, case when page_id = largest then 'response' else 'revisit' end as record_type,
  case when page_id <> largest then largest end as refers_to
from b
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
grams as (
  select lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as phrase
  from w, unnest([1, 2, 3, 4, 5]) as sizes(size) where len(w) >= size),
f as (select lang, size, phrase, count(*) as f from grams group by all having count(*) >= 100),
parts as (
  select lang, phrase, f, size, string_split(phrase, ' ') as w from f where size > 1),
inside as (
  select lang, array_to_string(unnest([w[1:size - 1], w[2:size]]), ' ') as phrase, f from parts where size > 2),
kept as (
  select * from parts p where not exists (select 1 from inside i where i.lang = p.lang and i.phrase = p.phrase and 100 * i.f >= 100 * p.f)),
cuts as (
  select lang, phrase, f as a, k, array_to_string(w[1:k], ' ') as head, array_to_string(w[k + 1:], ' ') as rest
  from kept, unnest(range(1, size)) as ks(k)),
scored as (
  select c.lang, c.phrase, c.a, k, h.f as l, r.f as r, t.n, (1000::hugeint * c.a * t.n) // (h.f::hugeint * r.f) as score
  from cuts c join f h on h.lang = c.lang and h.phrase = c.head join f r on r.lang = c.lang and r.phrase = c.rest
    join totals t on t.lang = c.lang),
least as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from least)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score from ranked where rank <= 2000
"""


OP12_SQL = rf"""
with d as (
  select row_number() over () as nth, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
sizes as (select nth, doc_id, len(w) as n from d where len(w) > 0),
totals as (select count(*) as n_docs, cast(sum(n) as bigint) as n_words from sizes),
items as (
  select item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
q as (select item_id, term, count(*) as q from items group by all),
tf as (
  select nth, term, count(*) as tf from (select nth, unnest(w) as term from d) where term in (select term from q) group by all),
weights as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
  from tf, totals group by term, n_docs),
impacts as (
  select nth, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words)) as impact
  from tf join sizes using (nth), totals),
scores as (
  select item_id, nth, doc_id, cast(sum(q * w * impact) as bigint) as score
  from q join weights using (term) join impacts using (term) group by all having score > 0),
ranked as (
  select *, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as int) as rank from scores)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""


OP13_SQL = r"""
with t as (select row_number() over () as nth, doc_id, coalesce(text, '') as t from documents),
k(place, kind, pattern, part) as (values
  (1, 'assign', '(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6),
  (2, 'access', '(AKIA[A-Z0-9]+)', 20),
  (3, 'hex', '([0-9a-f]{24,})', 24),
  (4, 'forge', '(gh[pousr]_[0-9A-Za-z]+)', 40),
  (5, 'registry', '(npm_[0-9A-Za-z]+)', 40)),
m as (
  select nth, place, kind, part, regexp_extract_all(t, pattern) as found, regexp_extract_all(t, pattern, 1) as held, string_split_regex(t, pattern) as rest
  from t, k where regexp_matches(t, pattern)),
s as (
  select nth, place, kind, part, held[i] as held, length(found[i]) as size,
    cast(list_sum(list_transform(rest[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as bigint) as start
  from m, unnest(range(1, len(found) + 1)) as n(i)),
byte as (
  select list_transform(range(256), lambda b: list_reduce(range(8), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b)) as byte),
sums as (
  select s.*, case when place > 3 then xor(4294967295, list_reduce(
    list_transform(string_split(substr(split_part(held, '_', 2), 1, 30), ''), lambda x: ascii(x)::bigint),
    lambda c, x: xor(c >> 8, byte[(xor(c, x) & 255) + 1]), 4294967295::bigint)) end as crc
  from s, byte),
sound as (
  select * from sums where case when place <= 3 then length(held) >= part
    else length(held) = part and substr(held, 35) = array_to_string(list_transform([916132832, 14776336, 238328, 3844, 62, 1],
      lambda p: substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', cast((crc // p) % 62 + 1 as int), 1)), '') end),
told as (
  select nth, count(*) filter (place = 1) as n_assign, count(*) filter (place = 2) as n_access, count(*) filter (place = 3) as n_hex,
    string_agg(kind || ':' || start || ':' || (start + size), ',' order by start, place) filter (place <= 3) as base,
    string_agg(kind || ':' || start || ':' || (start + size), ',' order by start, place) as spans
  from sound group by nth)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t left join told using (nth)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": OP1_SQL,
        "op7_warc": OP7_SQL,
        "op9_exact_dedup": OP9_SQL,
        "op11_phrases": OP11_SQL,
        "op12_search": OP12_SQL,
        "op13_secrets": OP13_SQL,
    }

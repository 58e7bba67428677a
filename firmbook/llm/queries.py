"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmbook.llm import audit, decontamination, html, jaccard, licences, packing, phrases, quality, rules, sharding, substrings, topk, toxicity

QUERIES, ORACLE = {}, {}


def registered(query):
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@registered
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).drop("representative")


@registered
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed_intervals(table(spark, sf_dir, "documents")).drop("starts", "ends")


@registered
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place_rows(table(spark, sf_dir, "documents"))


@registered
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.select(*[c for c in found.columns if c != "detections"])


@registered
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@registered
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@registered
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@registered
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


@registered
def op13_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"))


ORACLE["op9_exact_top_k"] = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from whole q join whole c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 100 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
where rank <= 10
"""

ORACLE["op3_ngram_jaccard_join"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as shingle
  from words, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as t(i)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
), links as (
  select a, b from common join sizes x on a = x.doc_id join sizes y on b = y.doc_id
  where 100 * common.n >= 75 * (x.n + y.n - common.n)
), both_ways as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id as a, doc_id as b from documents
  union
  select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a
)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id
from documents d left join sizes on d.doc_id = sizes.doc_id
join (select a, min(b) as component_id from reach group by a) on d.doc_id = a
"""

ORACLE["op5_substring_dedup"] = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, i, array_to_string(w[i : i + 12], ' ') as passage from words, unnest(range(1, len(w) - 11)) as t(i)
), first_seen as (
  select passage, min(doc_id) as first_id from windows group by passage
), gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as k
  from windows join first_seen using (passage) where first_id < doc_id
), placed as (
  select doc_id, k, w[k] as word from words, unnest(range(1, len(w) + 1)) as t(k)
), kept as (
  select p.doc_id, count(g.k) as n_removed, string_agg(word, ' ' order by p.k) filter (where g.k is null) as text
  from placed p left join gone g on p.doc_id = g.doc_id and p.k = g.k group by p.doc_id
)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from words left join kept using (doc_id)
"""

ORACLE["op12_quality_rules"] = r"""
with docs as (
  select row_number() over () as i, doc_id, lang, coalesce(text, '') as t from documents
), words as (
  select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g') as chars from docs
), windows as (
  select i, k, array_to_string(w[k : k + 2], ' ') as win from words, unnest(range(1, len(w) - 1)) as u(k)
), repeats as (
  select i, count(distinct place) as n from (
    select i, unnest(range(k, k + 3)) as place
    from (select *, count(*) over (partition by i, win) as times from windows) where times > 1) group by i
), lines as (
  select i, cast(count(*) - count(distinct line) as bigint) as n
  from (select i, unnest(string_split(t, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by i
), spoken as (
  select i, lang, unnest(w) as word from words
), totals as (
  select lang, count(*) as total from spoken group by lang
), common as (
  select s.lang, word, count(*) / any_value(total) as share
  from spoken s join totals t on s.lang is not distinct from t.lang
  group by s.lang, word having count(*) * 400 >= any_value(total)
), own as (
  select i, word, count(*) as n from spoken group by i, word
), word_bins as (
  select x.i, coalesce(o.n, 0) / len(x.w) as p, c.share as q
  from words x join common c on x.lang is not distinct from c.lang left join own o on o.i = x.i and o.word = c.word
  where len(x.w) > 0
), word_bins_all as (
  select i, p, q from word_bins
  union all
  select x.i, 1 - coalesce(sum(b.p), 0), 1 - coalesce(sum(b.q), 0) from words x left join word_bins b on x.i = b.i
  where len(x.w) > 0 group by x.i
), kinds as (
  select unnest(['[a-z]', '[\x{80}-\x{10FFFF}]', '[A-Z]', '[.,;:!?''"()-]', '[0-9]']) as kind
), class_counts as (
  select i, lang, kind, length(chars) - length(regexp_replace(chars, kind, '', 'g')) as n, length(chars) as n_chars from words, kinds
), class_counts_all as (
  select * from class_counts
  union all select i, lang, 'rest', any_value(n_chars) - sum(n), any_value(n_chars) from class_counts group by i, lang
), class_shares as (
  select lang, kind, sum(n) / sum(n_chars) as q from class_counts_all group by lang, kind having sum(n_chars) > 0
), class_bins as (
  select i, n / n_chars as p, q
  from class_counts_all c join class_shares s on c.lang is not distinct from s.lang and c.kind = s.kind where n_chars > 0
), parted as (
  select 'word' as side, i, p, q from word_bins_all union all select 'class', i, p, q from class_bins
), distances as (
  select i, side, sqrt(greatest(sum(
      case when p > 1e-12 then p * ln(2 * p / (p + q)) else 0 end + case when q > 1e-12 then q * ln(2 * q / (p + q)) else 0 end
    ) / 2, 0) / ln(2)) as d
  from parted group by i, side
), both_sides as (
  select i, max(d) filter (where side = 'class') as class_distance, max(d) filter (where side = 'word') as word_distance
  from distances group by i
), measured as (
  select x.doc_id, cast(len(x.w) as bigint) as n_words, cast(length(x.chars) as bigint) as word_chars,
         cast(length(x.chars) - length(regexp_replace(x.chars, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         coalesce(l.n, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words, class_distance, word_distance
  from words x left join lines l on x.i = l.i left join repeats r on x.i = r.i left join both_sides b on x.i = b.i
), failed as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(class_distance <= 0.2 + 1 / sqrt(n_words) and word_distance <= 0.3 + 1 / sqrt(n_words), true) as kept
from failed
"""

ORACLE["op13_source_divergence_audit"] = r"""
with docs as (
  select row_number() over () as i, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), counts as (
  select i, lang, source, term, count(*) as n from (select i, lang, source, unnest(w) as term from docs) group by all
), terms as (
  select lang, term, sum(n) as total from counts group by lang, term having count(*) >= 3
), langs as (
  select lang, count(*) as kept, sum(total) as lang_total from terms group by lang
), groups as (
  select distinct lang, source from docs
), own as (
  select c.lang, source, term, sum(n) as n from counts c join terms using (lang, term) group by all
), sums as (
  select lang, source, sum(n) as group_total from own group by all
), grid as (
  select g.lang, g.source, t.term, coalesce(o.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(o.n, 0) + 1)) // (coalesce(s.group_total, 0) + l.kept) as p,
         1 + (1000000000::hugeint * (t.total + 1)) // (l.lang_total + l.kept) as q
  from groups g join terms t using (lang) join langs l using (lang)
  left join sums s on g.lang = s.lang and g.source = s.source
  left join own o on g.lang = o.lang and g.source = o.source and t.term = o.term
), divergences as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from grid a join grid b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join divergences d on d.lang = a.lang and d.source = a.source and d.item = b.source
), more as (
  select lang, source, 'term' as part, term as item, cast((p - q) * (p - q) // q as bigint) as value
  from grid where n > 0 and p > q
)
select lang, source, part, item, value, cast(rank as integer) as rank from (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from more)
) where part = 'pair' or rank <= 200
"""

ORACLE["op11_phrase_collocations"] = r"""
with docs as (
  select row_number() over () as i, coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
), pieces as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from docs)
), ngrams as (
  select lang, size, array_to_string(w[k : k + size - 1], ' ') as phrase, count(*) as f
  from pieces, unnest([1, 2, 3, 4]) as s(size), unnest(range(1, len(w) - size + 2)) as u(k)
  group by all
), spoken as (
  select lang, cast(sum(f) as bigint) as n from ngrams where size = 1 group by lang
), known as (
  select lang, size, phrase, string_split(phrase, ' ') as w, f as a from ngrams where f >= 30
), cuts as (
  select lang, phrase, c.a, k, l.a as l, r.a as r, (2000000::hugeint * c.a) // (l.a::hugeint + r.a) as score
  from (select lang, phrase, a, k, array_to_string(w[1 : k], ' ') as p, array_to_string(w[k + 1 :], ' ') as q
        from known, unnest(range(1, size)) as u(k)) c
  join (select lang, phrase as p, a from known) l using (lang, p)
  join (select lang, phrase as q, a from known) r using (lang, q)
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), covered as (
  select lang, phrase, max(a) as longer from (
    select lang, a, array_to_string(w[k : k + part - 1], ' ') as phrase
    from known, unnest(range(2, size)) as s(part), unnest(range(1, size - part + 2)) as u(k))
  group by all
)
select lang, cast(rank as integer) as rank, phrase, a, l, r, n, cast(score as bigint) as score
from (
  select x.*, row_number() over (partition by x.lang order by score desc, a desc, x.phrase) as rank
  from lowest x left join covered c on x.lang = c.lang and x.phrase = c.phrase
  where longer is null or 100::hugeint * longer < 80::hugeint * a
) join spoken using (lang) where rank <= 2000
"""

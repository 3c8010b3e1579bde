"""Registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.llm import (
    collocations, conversations, decontaminate, exact_dedup, jaccard, language, licenses, mixing,
    quality, secrets, suffix_dedup, toxicity, warc,
)
from regweave.llm.common import id_remainder, stored, table

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), {az}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = _WORDS.replace("{az}", _AZ)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.report(licenses.scan(docs))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(suffix_dedup.dedup(table(spark, sf_dir, "documents")))


# Bytes as pairs of hexadecimal digits.
_OP2 = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h,
    octet_length(encode(coalesce(text, ''))) as n from documents),
windows as (select doc_id, s, substr(h, 2 * s + 1, 200) as w
  from (select doc_id, h, unnest(range(0, n - 99)) as s from d where n >= 100)),
gone as (select doc_id, s
  from (select doc_id, s, row_number() over (partition by w order by doc_id, s) as place from windows)
  where place > 1),
runs as (select doc_id, min(s) as b, max(s) + 100 as e
  from (select doc_id, s, sum(fresh) over (partition by doc_id order by s) as run
    from (select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 100
            then 0 else 1 end as fresh from gone))
  group by doc_id, run),
pieces as (select doc_id, b, e, coalesce(lag(e) over (partition by doc_id order by b), 0) as p from runs),
cut as (select doc_id, sum(e - b)::bigint as n_removed, count(*) as n_spans, max(e) as last,
    string_agg(substr(h, 2 * p + 1, 2 * (b - p)), '' order by b) as kept
  from pieces join d using (doc_id) group by doc_id)
select doc_id, n::bigint as n_bytes, coalesce(n_removed, 0) as n_removed,
  coalesce(n_spans, 0) as n_spans,
  sha256(unhex(case when last is null then h else kept || substr(h, 2 * last + 1) end))
    as kept_sha256
from d left join cut using (doc_id)
"""


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.scan(docs, table(spark, sf_dir, "benchmark")))


_OP3 = f"""
with d as (select doc_id, {_WORDS} as w from documents),
i as (select item_id, {_WORDS} as w from benchmark),
windows as (
  select distinct item_id, least(10, len(w)) as n,
    array_to_string(w[s + 1 : s + least(10, len(w))], ' ') as phrase
  from (select item_id, w, unnest(range(0, len(w) - least(10, len(w)) + 1)) as s
        from i where len(w) > 0)),
places as (
  select doc_id, s, n, array_to_string(w[s + 1 : s + n], ' ') as phrase
  from (select doc_id, w, n, unnest(range(0, len(w) - n + 1)) as s
        from d, (select distinct n from windows) where len(w) >= n)),
found as (select doc_id, s, n, item_id from places join windows using (n, phrase)),
hit as (select doc_id, count(distinct s + k) as n_hit
  from (select doc_id, s, unnest(range(0, n)) as k from (select distinct doc_id, s, n from found))
  group by doc_id),
items as (select doc_id, count(*) as n_items,
    string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from (select distinct doc_id, item_id from found) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join items using (doc_id)
"""


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rest = id_remainder("doc_id", 4)
    languages = language.fit(docs, rest != 2)
    named = language.identify(docs.select("doc_id", "text"), languages)
    held = F.coalesce(rest == 2, F.lit(False)).alias("held_out")
    return named.select("doc_id", held, "lang_pred", "score", "confident")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_classes(table(spark, sf_dir, "documents"))


_OP5 = r"""
with d as (select doc_id,
  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
  from documents),
g as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from d group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from d join g using (text_sha256)
"""


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.report(warc.read(warc.write(warc.decide(pages)), with_data=False))


_OP6 = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as payload_digest,
    octet_length(encode(coalesce(html, ''))) as payload_bytes from pages),
g as (select payload_digest, max(page_id) as best from p where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, p.payload_digest,
  case when payload_bytes >= 1000 and page_id <> best then 'revisit' else 'response' end
    as record_type,
  case when payload_bytes >= 1000 and page_id <> best then best end as refers_to
from p left join g on p.payload_digest = g.payload_digest
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = id_remainder("doc_id", 5)
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), rest != 0)
    scored = toxicity.score(docs, lexicon)
    held = F.coalesce(rest == 0, F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held, "score", predicted)


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


_OP8 = r"""
with d as (select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as h
  from documents),
s as (select source, sum(size)::bigint as source_size,
    case (row_number() over (order by source nulls last) - 1) % 3
      when 0 then 3 when 1 then 1 else 2 end as weight
  from d group by source),
f as (select *, sum(2 * source_size) over o - 2 * source_size as before,
    sum(weight) over () - sum(weight) over o + weight as open
  from s window o as (order by source_size / weight, source rows unbounded preceding)),
level as (select arg_min((1.5 * (select sum(source_size) from s) - before) / open,
    source_size / weight) as per_weight
  from f where 2.0 * source_size / weight
    >= (1.5 * (select sum(source_size) from s) - before) / open - 1e-9),
t as (select source, source_size,
    round(least(2.0 * source_size, weight * coalesce(per_weight, 1e18)), 6) as target
  from s, level),
b as (select *, target >= source_size as whole,
    round(target)::bigint - case when target >= source_size then source_size else 0 end as budget
  from t),
c as (select doc_id, size, source_size, target, whole, budget,
    sum(size) over (partition by d.source order by h, doc_id rows unbounded preceding) as upto
  from d join b on d.source is not distinct from b.source)
select doc_id, size, source_size, target,
  (size * (case when whole then 1 else 0 end
    + case when upto <= budget or upto - size <= budget and 2 * (budget - upto + size) > size
      then 1 else 0 end))::bigint as taken
from c
"""


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.report(secrets.scan(docs))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


# Components of different sets; documents with equal sets are one node.
_OP10 = rf"""
with recursive d as (select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i : i + 3], ' ') for i in range(1, len(w) - 2)]) end as g
  from d),
k as (select doc_id, len(g) as n, g, case when len(g) > 0
    then sha256(array_to_string(list_sort(g), chr(10))) end as class from s),
c as (select class, min(doc_id) as best, any_value(g) as g, any_value(n) as n
  from k where class is not null group by class),
t as (select class, n, unnest(g) as shingle from c),
pairs as (select x.class as a, y.class as b
  from t x join t y on x.shingle = y.shingle and x.class < y.class
  group by x.class, y.class, x.n, y.n
  having 100 * count(*) >= 85 * (x.n + y.n - count(*))),
links as (select a, b from pairs union all select b, a from pairs),
reached as (select class as node, class as root from c
  union select links.b, reached.root from reached join links on links.a = reached.node),
components as (select node as class, min(best) as component_id
  from reached join c on c.class = reached.root group by node)
select doc_id, n::bigint as n_shingles, coalesce(component_id, doc_id) as component_id
from k left join components using (class)
"""


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    found, words = collocations.phrases(docs)
    return collocations.report(collocations.collocations(found), words)


_OP11 = rf"""
with pieces as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), {_AZ}), '[.,;:!?
-
]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^ 	]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from w group by 1),
grams as (select lang, k, unnest([array_to_string(w[i : i + k - 1], ' ')
    for i in range(1, greatest(1, len(w) - k + 2))]) as phrase
  from w, (select unnest([1, 2, 3, 4]) as k)),
f as (select lang, phrase, k, count(*) as f from grams group by all having count(*) >= 30),
c as (select lang, phrase, k, f as a, string_split(phrase, ' ') as w from f where k > 1),
cuts as (select c.*, unnest(range(1, k)) as cut from c),
scored as (select cuts.lang, cuts.phrase, a, cut, l.f as l, r.f as r,
    (2000000::hugeint * a) // (l.f + r.f) as score
  from cuts join f l on l.lang = cuts.lang and l.phrase = array_to_string(w[1 : cut], ' ')
  join f r on r.lang = cuts.lang and r.phrase = array_to_string(w[cut + 1 :], ' ')),
best as (select * from scored qualify row_number() over
  (partition by lang, phrase order by score, cut) = 1),
parts as (select lang, a as f, k, w, unnest(range(1, k)) as i from c),
inside as (select distinct c.lang, c.phrase from c
  join (select lang, f, array_to_string(w[i : j], ' ') as phrase
      from (select *, unnest(range(i + 1, k + 1)) as j from parts) where j - i + 1 < k)
    as longer using (lang, phrase) where 100::hugeint * longer.f >= 80::hugeint * c.a),
ranked as (select *, row_number() over
    (partition by lang order by score desc, a desc, phrase) as rank
  from best anti join inside using (lang, phrase))
select lang, rank, phrase, a, l, r, n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = stored(quality.measure(docs), "quality-counts")
    return quality.report(quality.judge(measured, quality.fit(measured)))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.report(rows, conversations.repair(conversations.damage(rows)))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op4_language": op4_language,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op9_secrets": op9_secrets,
    "op10_jaccard": op10_jaccard,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op5_exact_dedup": op5_exact_dedup,
    "op8_mix": op8_mix,
    "op11_collocations": op11_collocations,
    "op12_quality": op12_quality,
    "op13_conversations": op13_conversations,
}
ORACLES = {
    "op2_suffix_dedup": _OP2,
    "op3_decontaminate": _OP3,
    "op5_exact_dedup": _OP5,
    "op6_warc": _OP6,
    "op8_mix": _OP8,
    "op10_jaccard": _OP10,
    "op11_collocations": _OP11,
}

"""The queries of this subpackage, and their SQL where SQL can say it. Each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopbank.llm import (
    decontamination, language_id, license_scan, line_dedup, manifest, mixing, near_dedup, quality, sharding,
    spelling, substring_dedup, token_counts, word_scoring,
)

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all pages; the text models are counted over all documents."""
    return language_id.identified(table(spark, folder, "pages"), table(spark, folder, "documents"))


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shards of nearly equal bytes; the largest group of equal texts sets the least they can be."""
    rows = sharding.sharded(table(spark, folder, "documents"), shards=40)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scanned(table(spark, folder, "documents"))


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Scores against the documents that are labelled good and not toxic."""
    good = table(spark, folder, "labels").where("quality = 1 and toxic = 0")
    return word_scoring.word_cross_entropy_difference(table(spark, folder, "documents"), good)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), budget=2048)
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"), "fitting_chars")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mixed(table(spark, folder, "documents"), weights=(5, 2, 1), most_repeats=3)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("n_copies") * F.col("size")).alias("taken"))


def op8_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.line_quality(table(spark, folder, "documents"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = substring_dedup.without_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span[1] - span[0])
    return rows.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    hits = decontamination.benchmark_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"), slip=97)


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.without_common_lines(table(spark, folder, "documents"), min_chars=20, min_docs=3)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Where 5 divides the checksum of the id, the verified copy is tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = manifest.manifest(table(spark, folder, "documents"), tampered)
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_language_id": op2_language_id,
    "op3_sharding": op3_sharding,
    "op4_license_scan": op4_license_scan,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_line_quality": op8_line_quality,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_spelling": op11_spelling,
    "op12_line_dedup": op12_line_dedup,
    "op13_manifest": op13_manifest,
}

_WORDS = rf"regexp_extract_all(coalesce(text, ''), '{WORD}')"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR_DEDUP = rf"""
with recursive texts as (
    select row_number() over () as r, doc_id, regexp_extract_all({_LOWER}, '{WORD}') as words from documents),
shingles as (
    select distinct r, unnest(list_transform(range(1, greatest(len(words) - 3, 2)), lambda p: array_to_string(words[p : p + 4], ' '))) as shingle
    from texts where len(words) > 0),
sizes as (select r, count(*)::bigint as n from shingles group by r),
common as (
    select a.r as x, b.r as y, count(*) as both_have
    from shingles a join shingles b on a.shingle = b.shingle and a.r <> b.r group by a.r, b.r),
links as (
    select x, y from common join sizes a on x = a.r join sizes b on y = b.r where 100 * both_have >= 75 * (a.n + b.n - both_have)),
reached(r, other) as (select r, r from texts union select reached.r, y from reached join links on other = x),
components as (select reached.r, min(doc_id) as component_id from reached join texts on other = texts.r group by reached.r)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id is not distinct from component_id as kept
from texts join components using (r) left join sizes using (r)
"""

_MIXING = rf"""
with sized as (
    select doc_id, source, len({_WORDS})::bigint as size,
           ('0x' || substr(md5(coalesce(doc_id::varchar, 'text ' || coalesce(text, ''))), 1, 15))::bigint as hash
    from documents),
sizes as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
    select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as weight from sizes),
ranked as (
    select *, row_number() over by_ratio as rank,
           (sum(source_size) over () - 3 * coalesce(sum(source_size) over before, 0))::bigint as rest,
           (sum(weight) over () - coalesce(sum(weight) over before, 0))::bigint as rest_weight
    from weighed
    window by_ratio as (order by source_size / weight, source nulls last),
           before as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
level as (
    select * from ranked where (weight * rest)::double / rest_weight <= 3 * source_size order by rank limit 1),
targets as (
    select r.source, r.source_size,
           case when l.rank is null or r.rank < l.rank then 3.0::double * r.source_size
                else (r.weight * l.rest)::double / l.rest_weight end as target
    from ranked r left join level l on true),
budgets as (
    select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from targets),
running as (
    select s.*, b.source_size, b.target, b.whole, b.target - b.whole * b.source_size as budget,
           sum(size) over (partition by s.source order by hash rows between unbounded preceding and current row)::bigint as upto
    from sized s join budgets b on s.source is not distinct from b.source)
select doc_id, size, source_size, target,
       (size * (whole + (upto <= budget or (upto - size <= budget and budget >= upto - size / 2.0::double))::bigint))::bigint as taken
from running
"""

_PHRASES = "|".join(quality.PHRASES)
_END = quality.SENTENCE_END.replace("'", "''")
_QUALITY = rf"""
with texts as (select row_number() over () as r, doc_id, coalesce(text, '') as text, {_WORDS} as words from documents),
lines as (
    select r, place, line, len(regexp_extract_all(line, '{WORD}')) as n,
           row_number() over (partition by r, line order by place) as nth
    from (select r, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as place from texts)
    where len(regexp_extract_all(line, '{WORD}')) > 0),
passed as (
    select r, sum((nth > 1)::bigint)::bigint as n_dup_lines,
           coalesce(sum(n) filter (
               where nth = 1
                 and 10 * len(regexp_extract_all(line, '[#*$%&|<>]')) < 3 * n
                 and 10 * len(regexp_extract_all(line, '!!')) < 3 * n
                 and (n < 3 or lines_of_text = 1 or regexp_matches(line, '{_END}'))
                 and (n > 20 or not regexp_matches(lower(line), '{_PHRASES}'))), 0)::bigint as n_kept_words
    from (select *, count(*) over (partition by r) as lines_of_text from lines) group by r),
grams as (
    select r, unnest(list_transform(range(1, len(words) - 3), lambda p: array_to_string(words[p : p + 4], ' '))) as gram,
           unnest(range(1, len(words) - 3)) as p
    from texts where len(words) >= 5),
windows as (select r, p, count(*) over (partition by r, gram) as times from grams),
repeats as (
    select r, count(distinct p + k)::bigint as n_repeat_words
    from windows, (select unnest([0, 1, 2, 3, 4]) as k) where times > 1 group by r),
figures as (
    select doc_id, len(words)::bigint as n_words,
           (len(text) - len(regexp_replace(text, '{WORD}', '', 'g')))::bigint as word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
           coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_kept_words, 0)::bigint as n_kept_words
    from texts left join passed using (r) left join repeats using (r))
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and 10 * n_kept_words >= 7 * n_words as kept
from figures
"""

_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAMINATION = rf"""
with texts as (select row_number() over () as r, doc_id, {_ITEM_WORDS} as words from documents),
items as (select coalesce(item_id::varchar, '') as item, {_ITEM_WORDS} as words from benchmark),
phrases as (
    select distinct item, least(len(words), 13) as width, array_to_string(words[p : p + 12], ' ') as phrase
    from (select *, unnest(range(1, greatest(len(words) - 11, 2))) as p from items where len(words) > 0)),
windows as (
    select r, p, width, array_to_string(words[p : p + width - 1], ' ') as phrase
    from (select *, unnest(range(1, len(words) - width + 2)) as p
          from texts, (select distinct width from phrases) where len(words) >= width)),
hits as (select r, p, w.width, item from windows w join phrases using (width, phrase)),
words_hit as (
    select r, count(distinct q)::bigint as n_hit
    from (select r, unnest(range(p, p + width)) as q from (select distinct r, p, width from hits)) group by r),
items_hit as (
    select r, count(*)::bigint as n_items, string_agg(item, ',' order by item) as names
    from (select distinct r, item from hits) group by r)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from texts left join words_hit using (r) left join items_hit using (r)
"""

_SUBSTRING_DEDUP = rf"""
with texts as (select row_number() over () as r, doc_id, {_WORDS} as words from documents),
windows as (
    select r, unnest(list_transform(range(1, len(words) - 33), lambda p: md5(array_to_string(words[p : p + 34], ' ')))) as name,
           unnest(range(1, len(words) - 33)) as p
    from texts where len(words) >= 35),
repeated as (select name from windows group by name having count(*) > 1),
removed as (
    select distinct r, p + k as q
    from windows join repeated using (name), (select unnest(range(0, 35)) as k)),
places as (select r, doc_id, unnest(words) as word, generate_subscripts(words, 1) as q from texts),
kept as (
    select p.r, count(x.q)::bigint as n_removed, string_agg(word, ' ' order by p.q) filter (where x.q is null) as left_over
    from places p left join removed x on p.r = x.r and p.q = x.q group by p.r)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(left_over, '')) as kept_sha256
from texts left join kept using (r)
"""

_WHITE = " || ".join(f"chr({ord(c)})" for c in line_dedup.WHITE)
_LINE_DEDUP = rf"""
with lines as (
    select r, doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as place
    from (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)),
keyed as (
    select *, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
common as (select key, max(doc_id) as last from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
marked as (select r, doc_id, place, line, coalesce(doc_id <> last, false) as gone from keyed left join common using (key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from marked group by r, doc_id
"""

#: The table of CRC-32, and the checksum of the bytes in a list (the polynomial is a fixed value).
_CRC_TABLE = """crc as (
    select list(c order by i) as crc_table from (
        select i, list_reduce(list_prepend(i, range(8)),
            lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as c
        from range(256) as t(i)))"""
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, {codes}),
        lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295::bigint)"""


def _measured(column: str) -> str:
    return f"coalesce(strlen({column}::varchar) || ':' || {column}::varchar, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_measured, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ID_CRC = _CRC.format(codes="list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::bigint)")
_MANIFEST = f"""
with recursive {_CRC_TABLE},
leaves as (
    select row_number() over () as r, doc_id, source, {_leaf('text')} as leaf,
           case when {_ID_CRC} % 5 = 0 then {_leaf(_LOWERED)} end as changed
    from documents, crc),
ordered as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as p, count(*) over (partition by source) as n
    from leaves),
nodes(level, source, n, p, digest) as (
    select 0::bigint, source, n, p, leaf from ordered
    union all
    select level + 1, source, (n + 15) // 16, p // 16, sha256(string_agg(digest, '' order by p))
    from nodes where n > 1 group by level, source, n, p // 16),
subroots as (
    select source, digest, row_number() over (order by source nulls first) - 1 as p, count(*) over () as n from nodes where n = 1),
tops(level, n, p, digest) as (
    select 0::bigint, n, p, digest from subroots
    union all
    select level + 1, (n + 15) // 16, p // 16, sha256(string_agg(digest, '' order by p)) from tops where n > 1 group by level, n, p // 16),
steps as (
    select r, level as step, string_agg(digest, '' order by x.p) filter (where x.p < o.p // (16 ** level)::bigint) as l,
           string_agg(digest, '' order by x.p) filter (where x.p > o.p // (16 ** level)::bigint) as r_
    from ordered o join nodes x on x.source is not distinct from o.source and x.n > 1 and x.p // 16 = o.p // (16 ** (level + 1))::bigint
    group by r, level
    union all
    select r, 1000 + level, string_agg(t.digest, '' order by t.p) filter (where t.p < s.p // (16 ** level)::bigint),
           string_agg(t.digest, '' order by t.p) filter (where t.p > s.p // (16 ** level)::bigint)
    from ordered o join subroots s on s.source is not distinct from o.source
        join tops t on t.n > 1 and t.p // 16 = s.p // (16 ** (level + 1))::bigint
    group by r, level),
paths as (
    select r, string_agg(coalesce(l, '') || coalesce(r_, ''), '' order by step) as siblings,
           list({{'l': coalesce(l, ''), 'r': coalesce(r_, '')}} order by step) as path
    from steps group by r),
folded as (
    select o.*, s.digest as subroot, t.digest as root, sha256(coalesce(siblings, '')) as proof_sha256,
           list_reduce(list_prepend({{'l': coalesce(changed, leaf), 'r': ''}}, coalesce(path, [])),
               lambda a, b: {{'l': sha256(b.l || a.l || b.r), 'r': ''}}).l as folded_root
    from ordered o join subroots s on s.source is not distinct from o.source join tops t on t.n = 1 left join paths using (r))
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from folded
"""

#: Letters beyond ASCII as single bytes, since edit distances count bytes.
_WIDE = "".join(chr(c) for c in range(0xC0, 0x100))
_NARROW = "".join(chr(c) for c in range(0x21, 0x61)).replace("'", "''")
_RUN_CRC = _CRC.format(codes="list_transform(range(1, octet_length(name) + 1), lambda i: ('0x' || substr(hex(name), 2 * i - 1, 2))::bigint)")
_SPELLING = rf"""
with recursive {_CRC_TABLE},
runs as (select doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) as run from documents),
counted as (select doc_id, run, count(*) as k, encode(coalesce(doc_id::varchar, '') || ':' || run) as name from runs group by doc_id, run),
summed as (select *, {_RUN_CRC} as h from counted, crc),
altered as (
    select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, k from summed),
words as (
    select word, sum(k)::bigint as n, translate(word, '{_WIDE}', '{_NARROW}') as bytes
    from altered where length(word) >= 5 group by word having sum(k) >= 3),
keys as (
    select word, n, bytes, bytes as key from words
    union
    select word, n, bytes, unnest(list_transform(range(1, length(bytes) + 1), lambda i: substr(bytes, 1, i - 1) || substr(bytes, i + 1))) from words),
pairs as (
    select distinct a.word, a.n, b.word as near, b.n as near_n
    from keys a join keys b using (key) where a.word <> b.word and levenshtein(a.bytes, b.bytes) = 1),
best as (
    select word, count(*) as n_near, min({{'order': -near_n, 'near': near}}) as best from pairs group by word),
forms as (
    select w.word, w.n, coalesce(n_near, 0)::bigint as n_near,
           case when -best['order'] >= 2 * n then best['near'] end as form, case when -best['order'] >= 2 * n then -best['order'] end as form_n
    from words w left join best using (word)),
chains(word, reached, next) as (
    select word, word, form from forms
    union all
    select c.word, f.word, f.form from chains c join forms f on f.word = c.next)
select f.word, form, reached as root, n, n_near, form_n::bigint as form_n
from forms f join chains c on c.word = f.word and c.next is null
"""

SQL: dict[str, str] = {
    "op1_near_dedup": _NEAR_DEDUP,
    "op7_mixing": _MIXING,
    "op8_line_quality": _QUALITY,
    "op9_substring_dedup": _SUBSTRING_DEDUP,
    "op10_decontamination": _DECONTAMINATION,
    "op11_spelling": _SPELLING,
    "op12_line_dedup": _LINE_DEDUP,
    "op13_manifest": _MANIFEST,
}

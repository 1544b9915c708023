"""The queries of this subpackage, one per operator, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltline.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import weighted_sampling

    return weighted_sampling.fingerprints(table(spark, sf_dir, "documents"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import licences

    return licences.scan(table(spark, sf_dir, "documents"))


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import suffix_array

    return suffix_array.repeated_passages(table(spark, sf_dir, "documents"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import pieces

    return pieces.digests(table(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import substrings

    return substrings.remove(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import sharding

    return sharding.interleave(table(spark, sf_dir, "documents"))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import vectors

    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import language

    return language.identify(table(spark, sf_dir, "documents"))


def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import mixing

    return mixing.mixture(table(spark, sf_dir, "documents"))


def op11_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import middle

    return middle.digests(table(spark, sf_dir, "documents"))


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import token_counts

    return token_counts.count(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltline.llm import collocations

    return collocations.collocations(table(spark, sf_dir, "documents"))


#: Needs the md5 that both engines have; the checksum of a text is folded byte by byte.
OP7 = """
with tab as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, k: case when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end)) as t),
rows as (select doc_id, coalesce(source_name, 't') as grp, coalesce(text, '') as text,
    md5('shards-1:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as key
  from (select *, 's' || source as source_name from documents)),
placed as (select *, row_number() over (partition by grp order by key) - 1 as place, count(*) over (partition by grp) as n,
    cast(('0x' || substr(md5('shards-1:' || grp), 1, 8))::bigint as double) / 4294967296.0 as shift from rows),
ranked as (select *, row_number() over (order by (place + shift) / n, grp, key) - 1 as spot, count(*) over () as total from placed),
cut as (select *, spot * 24 // total as shard from ranked)
select doc_id, cast(octet_length(encode(text)) + 8 as bigint) as size,
  cast(xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::bigint)),
    lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) as bigint) as text_crc32,
  'rows' as law, cast(shard as int) as shard, cast(spot - (shard * total + 23) // 24 as bigint) as slot, cast(null as int) as grown_shard
from cut, tab
"""
#: Seats go to the highest quotients, one row for each block that a source may bid for.
OP10 = """
with rows as (select doc_id, coalesce('s' || source, 't') as grp, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
    md5('mixture-1:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as key from documents),
groups as (select grp, cast(sum(size) as bigint) as s, case row_number() over (order by encode(grp)) % 3 when 1 then 5 when 2 then 2 else 1 end as w from rows group by 1),
level as (select *, sum(3 * s) over o as capped, sum(w) over o as gone, sum(s) over () as total, sum(w) over () as weights
  from groups window o as (order by 3.0 * s / w, encode(grp) rows between unbounded preceding and 1 preceding)),
free as (select *, 3 * s * (weights - coalesce(gone, 0)) > w * (total - coalesce(capped, 0)) as over from level),
rate as (select any_value(total) as total, any_value(total) - coalesce(sum(case when not over then 3 * s end), 0) as words,
    any_value(weights) - coalesce(sum(case when not over then w end), 0) as parts from free),
goals as (select grp, s, case when over then cast(w * words as double) / cast(parts as double) else cast(3 * s as double) end as target, free.total from free, rate),
blocked as (select *, greatest(1, least(1024, cast(floor((select min(target) from goals where target > 0) / 400) as bigint))) as b from goals),
sized as (select *, cast(ceil(s / b) as bigint) as own, cast(ceil(total / b) as bigint) as seats_all from blocked),
bids as (select grp, round(target / (2 * k + 1), 6) as bid, seats_all from (select *, unnest(range(3 * own)) as k from sized)),
won as (select grp, count(*) as seats from (select *, row_number() over (order by bid desc, encode(grp)) as r from bids) where r <= seats_all group by 1),
plan as (select sized.*, coalesce(seats, 0) as seats, cast(floor(cast(('0x' || substr(md5('mixture-1:' || grp), 1, 8))::bigint as double) / 4294967296.0 * own) as bigint) as first
  from sized left join won using (grp)),
runs as (select *, case when own = 0 then 0 else seats // own end as passes, first * b as low, least(s, (first + seats % greatest(own, 1)) * b) as high,
    greatest(0, first + seats % greatest(own, 1) - own) * b as round_to from plan),
placed as (select rows.*, coalesce(sum(size) over (partition by grp order by key rows between unbounded preceding and 1 preceding), 0) as start from rows)
select doc_id, size, s as source_size, target, cast(passes * size + greatest(0, least(start + size, high) - greatest(start, low))
  + greatest(0, least(start + size, round_to) - start) as bigint) as taken
from placed join runs using (grp)
"""
#: Prefix and middle end after first and second code points.
OP11 = """
with rows as (select doc_id, coalesce(text, '') as text, cast(length(coalesce(text, '')) as bigint) as n, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as k from documents),
drawn as (select *, ('0x' || substr(k, 1, 8))::bigint % (n + 1) as x, ('0x' || substr(k, 9, 8))::bigint % (n + 1) as y,
    ('0x' || substr(k, 17, 8))::bigint % 100 as chance, ('0x' || substr(k, 25, 8))::bigint % 100 as turn from rows),
formed as (select *, least(x, y) as first, greatest(x, y) as second, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or chance >= 90
    then 'plain' when turn < 20 then 'spm' else 'psm' end as form from drawn),
parts as (select *, substr(text, 1, first) as p, substr(text, first + 1, second - first) as m, substr(text, second + 1) as s from formed)
select doc_id, n, form, case when form <> 'plain' then first end as prefix_chars, case when form <> 'plain' then second - first end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""
#: All runs of one to four words as rows.
OP13 = """
with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece from documents),
listed as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from listed group by 1),
runs as (select lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) as phrase
  from listed, range(1, 5) as s(size) where len(w) >= size),
freq as (select lang, phrase, size, count(*) as f, string_split(phrase, ' ') as w from runs group by all having count(*) >= 30),
cuts as (select lang, phrase, f as a, k, array_to_string(w[1:k], ' ') as head, array_to_string(w[k + 1:size], ' ') as tail
  from (select *, unnest(range(1, size)) as k from freq where size >= 2)),
scored as (select cuts.*, h.f as l, t.f as r, cast((2000000::hugeint * a) // (h.f + t.f) as bigint) as score
  from cuts join freq h on h.lang = cuts.lang and h.phrase = head join freq t on t.lang = cuts.lang and t.phrase = tail),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (select lang, f, array_to_string(w[i:i + s - 1], ' ') as phrase
  from (select *, unnest(range(1, size - s + 2)) as i from (select *, unnest(range(2, size)) as s from freq where size >= 3))),
longer as (select lang, phrase, max(f) as longer from inside group by all),
free as (select best.* from best left join longer using (lang, phrase) where longer is null or 100::hugeint * longer < 80::hugeint * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from free)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

QUERIES = {q.__name__: q for q in (op1_simhash, op2_fingerprints, op3_licences, op4_passages, op5_pieces, op6_substrings, op7_sharding, op8_vectors, op9_language, op10_mixture,
                                  op11_middle, op12_tokens, op13_collocations)}
ORACLES: dict[str, str] = {"op7_sharding": OP7, "op10_mixture": OP10, "op11_middle": OP11, "op13_collocations": OP13}

"""The registered queries of the operators and the SQL each is checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .exact_copies import exact_copies
from .licenses import scan_licenses
from .near_copies import near_copies
from .ngram_lm import score_texts
from .packing import pack
from .pieces import encode_pieces
from .prefix_trie import conversation_trie
from .quality import COUNTS, quality_rules
from .sharding import document_shards
from .spelling import spelling_variants
from .token_files import token_files
from .url_filter import claimed_twice, filter_urls
from .warc import warc_round_trip


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc_round_trip(read(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(read(spark, folder, "documents")).drop("spans")


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url")
    return filter_urls(pages, claimed_twice(pages))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(read(spark, folder, "documents")).select("doc_id", *COUNTS, "base_failed", "kept", "distance")


def op6_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(read(spark, folder, "documents"))


def op7_exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    return exact_copies(read(spark, folder, "documents")).drop("same_row")


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encode_pieces(read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), outputs=False)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)


def op10_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(read(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(read(spark, folder, "documents"), typos=97)


def op12_document_shards(spark: SparkSession, folder: str) -> DataFrame:
    return document_shards(read(spark, folder, "documents"))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(read(spark, folder, "conversations"), rebuild=True)


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_warc": op2_warc,
    "op3_licenses": op3_licenses,
    "op4_url_filter": op4_url_filter,
    "op5_quality_rules": op5_quality_rules,
    "op6_near_copies": op6_near_copies,
    "op7_exact_copies": op7_exact_copies,
    "op8_pieces": op8_pieces,
    "op9_packing": op9_packing,
    "op10_ngram_lm": op10_ngram_lm,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_document_shards": op12_document_shards,
    "op13_conversation_trie": op13_conversation_trie,
}

#: The table of CRC-32 by its rule, and a text's CRC-32 by that table.
_CRC_TABLE = """crc_table as materialized (select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crcs)"""


def _crc(x: str) -> str:
    return (f"xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode({x})), '..'), lambda h: ('0x' || h)::bigint)), "
            "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)")


ORACLES = {
    "op2_warc": """
select page_id, octet_length(encode(t)) as payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda j: (2 ** (4 - j))::int * substr(b, (5 * i + j + 1)::int, 1)::int))::int, 1)), '')
    as payload_digest,
  case when page_id = m then 'response' else 'revisit' end as record_type, case when page_id <> m then m end as refers_to
from (select page_id, t, unhex(sha1(t))::bit::varchar as b, min(page_id) over (partition by t) as m
  from (select page_id, coalesce(html, '') as t from pages))""",
    "op4_url_filter": r"""
with cut as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
named as (select *, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
    lambda p: p <> '' and not regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') as query from cut),
formed as (select *, case when h <> '' then h || regexp_replace(path, '/+$', '') || case when query <> '' then '?' || query else '' end end as canonical
  from (select *, regexp_replace(regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':(80|443)$', ''), '^www\.', '') as h from named)),
ruled as (select *, case when host = 'example.org' or host like '%.example.org' then
    case when starts_with(path, '/en/1') then 'example.org/en/1' when starts_with(path, '/es/') then 'example.org/es/' when starts_with(path, '/') then 'org/' end
  when host = 'org' or host like '%.org' then case when starts_with(path, '/') then 'org/' end
  when host = 'com' or host like '%.com' then case when starts_with(path, '/fr/') then 'com/fr/' when starts_with(path, '/de/') then 'com/de/' end end as rule,
  coalesce(count(*) over (partition by canonical) > 1 and canonical is not null, false) as listed from formed)
select page_id, host, path, rule, case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null or listed then 'block' else 'allow' end as verdict, listed
from ruled""",
    "op7_exact_copies": """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept,
  sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))""",
    "op11_spelling_variants": f"""
with recursive {_CRC_TABLE},
runs as (select doc_id, run, count(*) as n from (select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run from documents) where length(run) >= 5 group by all),
hashed as (select *, {_crc("concat(doc_id, ':', run)")} as h from runs, crc_table),
words as materialized (select word, sum(n)::bigint as n from (
    select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed)
  where length(word) >= 5 group by word having sum(n) >= 3),
cuts as materialized (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as cut from (select word, n, unnest(range(length(word))) as i from words)),
pairs as (select a.word, b.word as other, b.n as m from cuts a join cuts b on a.cut = b.cut and a.i = b.i and a.word <> b.word
  union select c.word, w.word, w.n from cuts c join words w on c.cut = w.word union select w.word, c.word, c.n from cuts c join words w on c.cut = w.word),
best as (select word, count(*) as n_near, max(m) as m from pairs group by word),
firsts as (select word, n_near, m, min(other) as other from best join pairs using (word, m) group by all),
formed as materialized (select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 2 * w.n then other end as form, case when m >= 2 * w.n then m end as form_n
  from words w left join firsts f on f.word = w.word),
walk as (select word, form as root from formed where form is not null union all select w.word, f.form from walk w join formed f on f.word = w.root where f.form is not null),
ends as (select word, root from walk where root in (select word from formed where form is null))
select f.word, form, coalesce(root, f.word) as root, n, n_near, form_n from formed f left join ends e on e.word = f.word""",
    "op12_document_shards": f"""
with {_CRC_TABLE},
sized as (select doc_id, coalesce(text, '') as t, octet_length(encode(coalesce(text, ''))) + 1 as size from documents),
ordered as (select *, sum(size) over (order by sha256(t), doc_id nulls first rows unbounded preceding) - size as before, sum(size) over () as total from sized),
dealt as (select *, (before * 8) // total as shard from ordered)
select doc_id, size, {_crc("t")} as text_crc32, 'bytes' as law, shard::int as shard, row_number() over (partition by shard order by before) - 1 as slot,
  null::int as grown_shard from dealt, crc_table""",
    "op13_conversation_trie": f"""
with {_CRC_TABLE},
own as materialized (select conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) order by turn nulls first, role, text) as turns
  from conversations where conv_id is not null group by conv_id),
heads as (select *, {_crc("conv_id::varchar")} % 6 as h from own, crc_table),
built as materialized (select c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) as turns from heads c left join own b on b.conv_id = c.conv_id - c.conv_id % 100),
steps as (select conv_id, len(turns) as own_length, unnest(range(len(turns) + 1)) as depth, turns from built),
nodes as materialized (select depth, turns[1:depth] as path, min(conv_id) as conv_id, count(*) as n_convs, case when depth = 0 then 0 else length(any_value(turns[depth].t)) end as chars,
  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where own_length = depth), '')) as ends_sha256 from steps group by depth, turns[1:depth]),
kids as materialized (select p.depth, p.path, count(c.depth) as n_children, any_value(u.conv_id) as parent_conv_id
  from nodes p left join nodes c on c.depth = p.depth + 1 and c.path[1:p.depth] = p.path left join nodes u on u.depth = p.depth - 1 and u.path = p.path[1:p.depth - 1] group by p.depth, p.path)
select n.conv_id, n.depth, k.parent_conv_id, n.n_convs, k.n_children, n.ends_sha256, count(*) filter (where bk.n_children = 0) as n_leaves, sum((b.n_convs - 1) * b.chars)::bigint as saved_tokens
from nodes n join kids k on k.depth = n.depth and k.path = n.path join nodes b on b.depth >= n.depth and b.path[1:n.depth] = n.path
  join kids bk on bk.depth = b.depth and bk.path = b.path group by all""",
}

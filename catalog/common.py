"""Inputs and SQL fragments that the query modules share.

Test tables hold no Bengali and no metadata, so inputs wrap their texts in
literal fragments. Those wrappers are written in SQL that both engines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SPACES = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = f"[{SPACES}]"
WORD = r"[\p{L}\p{N}_]"
BN = r"\x{0980}-\x{09ff}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---- wrapped inputs, in SQL common to Spark and DuckDB ------------------------

MARKED = """concat(text, case doc_id % 9
  when 0 then concat(' ', '£', '5')
  when 1 then ' কখग'
  when 2 then concat(' $', chr(9), 'x$')
  when 3 then ' $5'
  when 4 then concat(' a', chr(1), 'b')
  when 5 then concat(chr(10), '-- ==', chr(10), '```py £', chr(10), 'x')
  when 6 then concat(' ক।ग ১২৩,', doc_id, '.5 - (B) চূড়ান্ত উত্তর: ', doc_id % 40, ' টি')
  when 7 then ' go go go go' else '  ' end)"""

RAW = """concat('প্রশ্ন: ', doc_id % 50, ' + ৩.', doc_id % 7, ' ', text, chr(10),
  case when doc_id % 10 = 9 then '' else concat('উত্তর:', chr(10)) end, ' = ', doc_id, '। ')"""

PIPE = """concat('Guide.', chr(10), '[metadata: জেলা: ', source, ' | শ্রেণী: ',
  case doc_id % 4 when 0 then '১০ম' when 1 then 'দশম' when 2 then concat('class ', doc_id % 12 + 1) else 'অজানা' end,
  ' | বিষয়: ', case doc_id % 5 when 0 then 'গণিত' when 1 then 'জীবন বিজ্ঞান (Biology)' when 2 then 'ভৌত বিজ্ঞান'
  when 3 then lang else '' end, ' | পাঠ্য অধ্যায়: ', substr(text, 1, 30), ']')"""

BULLETS = """concat(text, chr(10), 'পাঠ্যসূচি বিবরণী', chr(10), '- বিষয়: ', case doc_id % 3 when 0 then 'EVS' when 1 then lang else '' end,
  chr(10), '- শ্রেণি: ', doc_id % 12 + 1, chr(10), '- বিষয়বস্তু: ', source, ' | x', chr(10), '- অঞ্চল/জেলা: ', lang, chr(10))"""

ENGLISH = """concat('Rules.', case doc_id % 3 when 0 then concat(chr(10), 'CONTEXT', chr(10)) when 1 then 'CONTEXT a CONTEXT' else '' end,
  'grade: ', doc_id % 12, ' | x', chr(10), 'Subject: ', lang, chr(10), 'topic: ', substr(text, 1, 60), ' ',
  case when doc_id % 4 = 0 then '' else concat(chr(10), 'state: WB', chr(10)) end, chr(10), 'district: ', source, chr(10),
  'terrain: ', case when doc_id % 2 = 0 then 'hill' else '|' end)"""


def documents(spark: SparkSession, folder: str, **columns: str) -> DataFrame:
    """The documents with extra columns given as common SQL."""
    rows = table(spark, folder, "documents")
    return rows.select("*", *[F.expr(sql).alias(name) for name, sql in columns.items()])


# ---- DuckDB fragments ---------------------------------------------------------

def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def fold(x: str) -> str:
    return f"translate({x}, '০১২৩৪৫৬৭৮৯', '0123456789')"


def first_line(x: str) -> str:
    return f"split_part({x}, chr(10), 1)"


def tokens(x: str, kind: str = "bn") -> str:
    pattern = {"word": f"{WORD}+", "ascii": "[a-z0-9]+", "bn": f"[{BN}]+|[a-z0-9]+",
               "term": rf"[{BN}\p{{L}}\p{{N}}_]+", "term2": WORD + "{2,}"}[kind]
    low = f"lower({x})"
    return f"regexp_extract_all({fold(low) if kind == 'bn' else low}, '{pattern}')"


def normal_form(x: str, kind: str = "bn") -> str:
    keep = r"\p{L}\p{N}_" + SPACES + ("" if kind == "word" else BN)
    low = f"lower({x})" if kind == "word" else fold(f"lower({x})")
    return strip(f"regexp_replace(regexp_replace({low}, '[^{keep}]+', '', 'g'), '{SPACE}+', ' ', 'g')")


def digest(x: str) -> str:
    return f"substr(sha256({x}), 1, 16)"


def hashed(seed: int, key: str) -> str:
    return f"md5(concat('{seed}|', {key}))"

"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontamination import find_leaks
from .fingerprints import fingerprint_edits
from .license_scan import scan_licenses
from .mixing import mix_sources
from .ngram_join import ngram_components
from .preferences import format_preferences, whole_pairs
from .pseudonyms import pseudonymize
from .spelling import ONE_IN, spelling_variants
from .token_files import read_token_files, write_token_files
from .toxicity import score_toxicity
from .url_rules import Rule, judge_urls
from .warc import read_warc, write_warc
from .whitening import whiten_embeddings


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, shards = write_token_files(table(spark, sf_dir, "documents"), tokenizer_path(), added=True)
    return read_token_files(shards)


#: Key of the registered query; a real run passes a secret of its own.
PSEUDONYM_KEY = b"documents of the public test tables"


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op6_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = whole_pairs(table(spark, sf_dir, "conversations"))
    return format_preferences(pairs, tokenizer_path()).withColumnRenamed("pair_id", "conv_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), step=1)


#: The rules of the URL query.
RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = """
with cut as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
hosts as (
  select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from cut),
parts as (
  select page_id,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path
  from hosts),
rules(action, rhost, rpath) as (
  values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best as (
  select p.page_id, p.host, p.path,
         arg_max(rhost || rpath, length(rhost || rpath)) as rule,
         arg_max(action, length(rhost || rpath)) as action
  from parts p left join rules
    on (p.host = rhost or ends_with(p.host, '.' || rhost)) and starts_with(p.path, rpath)
  group by all)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from best
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder, index = write_warc(pages)
    return read_warc(folder, index, pages.select("url")).drop("html")


OP10_SQL = """
with payloads as (
  select page_id, coalesce(html, '') as body, url from pages),
digests as (
  select page_id, octet_length(encode(body)) as payload_bytes, sha256(body) as payload_digest, url from payloads),
firsts as (
  select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first_id
  from digests)
select page_id, payload_bytes, payload_digest,
       case when first_id <> page_id then 'revisit' else 'response' end as record_type,
       case when first_id <> page_id then first_id end as refers_to, url
from firsts
"""


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), one_in=ONE_IN)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_fingerprints": op3_fingerprints,
    "op4_token_files": op4_token_files,
    "op5_pseudonyms": op5_pseudonyms,
    "op6_preferences": op6_preferences,
    "op7_decontamination": op7_decontamination,
    "op8_url_rules": op8_url_rules,
    "op9_mixing": op9_mixing,
    "op10_warc": op10_warc,
    "op11_whitening": op11_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_license_scan": op13_license_scan,
}

ORACLE = {
    "op8_url_rules": OP8_SQL,
    "op10_warc": OP10_SQL,
}

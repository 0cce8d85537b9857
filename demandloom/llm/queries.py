"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import (
    fim, jaccard, leaks, lexical, licences, pieces, quality, records, repeats, secret_scan, sharding, simhash, url_rules,
)
from demandloom.llm.common import new_path, staged, table

#: The rules of the url contract.
URL_RULES = (
    url_rules.Rule("com", "/", "allow"),
    url_rules.Rule("example.com", "/en/", "block"),
    url_rules.Rule("www.example.com", "/en/", "allow"),
    url_rules.Rule("net", "/es/", "block"),
    url_rules.Rule("net", "/fr/", "block"),
)
#: Hosts on the block list; they decide where no rule fits.
LISTED_HOSTS = ("cheap-pills.example.com", "cheap-pills.example.net", "spam-farm.example.net", "spam-farm.example.org")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes."""
    return sharding.place(table(spark, sf_dir, "documents"), shards=8)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES, LISTED_HOSTS)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text decoded from them."""
    return pieces.digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as framed records in the shared folder, and what reading them back gives."""
    manifest = records.write_records(
        table(spark, sf_dir, "documents"), new_path(spark, "id-records"), public_tokenizers.path("word_bpe_49k.json"), 2
    )
    return records.read_records(staged(manifest, "id-manifest"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, exact or edited, with the share of a full match."""
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and the smallest doc_id reachable over links of similarity 0.8 or more."""
    return jaccard.join(table(spark, sf_dir, "documents"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entire texts and lines that are a known licence or notice."""
    return licences.scan(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the fitted quality rule for every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by pattern and by structure."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that a smaller doc_id has."""
    return repeats.deduplicate(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every test item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document with its middle moved to the end, and of the text restored from that."""
    made = fim.restore(fim.transform(table(spark, sf_dir, "documents")))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id reachable over links of four different bits or fewer."""
    return simhash.join(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_url_filters": op2_url_filters,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_binary_output": op4_binary_output,
    "op5_decontamination": op5_decontamination,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_licences": op7_licences,
    "op8_quality": op8_quality,
    "op9_secrets": op9_secrets,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_simhash": op13_simhash,
}

_HOST = r"translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES: dict[str, str] = {
    "op2_url_filters": f"""
WITH parts AS (
    SELECT page_id, coalesce({_HOST}, '') AS host, coalesce({_PATH}, '') AS path FROM pages
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
    SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           max_by(verdict, length(rule_host || rule_path)) AS verdict
    FROM parts JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(host,
           '(^|\\.)(cheap-pills\\.example\\.(com|net)|spam-farm\\.example\\.(net|org))$') THEN 'block' ELSE 'allow' END)
       AS verdict
FROM parts LEFT JOIN fits USING (page_id)
""",
    "op11_lexical_search": rf"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents
), sizes AS (
    SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), totals AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes
), wanted AS (
    SELECT item_id, unnest(list_distinct(regexp_extract_all({_LOWER}, '{_TERM}'))) AS term FROM benchmark
), counts AS (
    SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
), impacts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))) AS part
    FROM counts JOIN sizes USING (doc_id) JOIN weights USING (term), totals
), scores AS (
    SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
""",
    "op12_fill_in_middle": r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
           sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest
    FROM documents
), drawn AS (
    SELECT doc_id, text, units, len(units) AS n,
           ('0x' || substr(digest, 1, 8))::BIGINT % (len(units) + 1) AS one,
           ('0x' || substr(digest, 9, 8))::BIGINT % (len(units) + 1) AS two,
           ('0x' || substr(digest, 25, 8))::BIGINT % 100 AS side
    FROM cut
), parts AS (
    SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                                 THEN 'plain' WHEN side < 50 THEN 'spm' ELSE 'psm' END AS form,
           coalesce(array_to_string(units[1:least(one, two)], ''), '') AS prefix,
           coalesce(array_to_string(units[least(one, two) + 1:greatest(one, two)], ''), '') AS middle,
           coalesce(array_to_string(units[greatest(one, two) + 1:], ''), '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}

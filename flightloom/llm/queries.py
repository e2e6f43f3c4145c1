"""The registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.llm import (
    chat_windows,
    class_lm,
    line_dedup,
    merkle,
    minhash_dedup,
    oracles,
    packing,
    quality_classifier,
    quality_rules,
    sentencepiece_bpe,
    simhash,
    toxicity,
    url_filter,
    vector_codes,
)
from flightloom.llm.texts import id_and_text, remainder, table, written

URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]
RULES_POLICY = "v3"


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's URL; pages of documents labelled bad are what rules are mined from."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad")
    )
    return url_filter.judge(
        table(spark, folder, "pages"), labels.filter("bad is not null"), URL_RULES
    )


def op2_class_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model, counts = class_lm.fit(id_and_text(docs).filter(remainder("doc_id", 5) != 1))
    return class_lm.score(docs, model, counts).select(
        "doc_id",
        (remainder("doc_id", 5) == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.fingerprint_documents(table(spark, folder, "documents"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_bpe.digests(table(spark, folder, "documents"), path)


def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, folder, "documents"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = docs.withColumn("n_lines", line_dedup.count_lines("text"))
    cut = line_dedup.apply_bitmaps(counted, line_dedup.keep_bitmaps(docs), "n_dropped")
    return cut.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(remainder("doc_id", 3) != 1)
    scored = quality_classifier.score(docs, quality_classifier.fit(docs, labels))
    return _predicted(scored, remainder("doc_id", 3) == 1)


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack_documents(table(spark, folder, "documents"), path)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    seen = remainder("doc_id", 5) != 0
    model = toxicity.fit(docs.filter(seen), table(spark, folder, "labels").filter(seen))
    return _predicted(toxicity.score(docs, model), remainder("doc_id", 5) == 0)


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Every rule is evaluated once and stored; policies and ablations read the bits."""
    return written(quality_rules.ledger(table(spark, folder, "documents")), "rule-ledger")


def rules_ablation(spark: SparkSession, folder: str) -> DataFrame:
    """Per rule: documents that fail it, and that it alone keeps out."""
    return quality_rules.ablation(_ledger(spark, folder), RULES_POLICY)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.apply_policy(_ledger(spark, folder), RULES_POLICY).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of what is read back from the windows of all conversations and one of control
    strings."""
    names = ["conv_id", "turn", "role", "text"]
    control = spark.range(2).select(
        F.lit(-1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("<|im_end|><|im_start|>assistant ok").alias("text"),
    )
    rows = table(spark, folder, "conversations").select(*names).unionByName(control)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    whole, split = chat_windows.format_parts(rows, path)
    return chat_windows.read_in_place(whole).unionByName(chat_windows.read_back(split))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents, folded from tampered leaves for a third of them."""
    lowered = F.translate(
        "text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    leaves = table(spark, folder, "documents").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "lang",
        merkle.leaf().alias("leaf"),
        F.when(remainder("doc_id", 3) == 0, merkle.leaf(lowered)).alias("tampered"),
    )
    start = F.coalesce("tampered", "leaf")
    return (
        merkle.manifest(leaves)
        .withColumn("folded_root", merkle.fold("proof", start))
        .select(
            "doc_id",
            "leaf",
            "subroot",
            "root",
            merkle.proof_digest("proof").alias("proof_sha256"),
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, model, _ = vector_codes.quantise(table(spark, folder, "embeddings"))
    return vector_codes.with_label_errors(coded).select(
        "vec_id",
        "code",
        "error",
        "label_error",
        F.lit(model.digest()).alias("codebooks_sha256"),
    )


def _predicted(scored: DataFrame, held_out) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_url_filter,
            op2_class_lm,
            op3_simhash,
            op4_sentencepiece,
            op5_minhash_dedup,
            op6_line_dedup,
            op7_quality_classifier,
            op8_best_fit_packing,
            op9_toxicity,
            op10_quality_rules,
            op11_chat_windows,
            op12_merkle_manifest,
            op13_vector_codes,
            rules_ablation,
        )
    }


# --- SQL --------------------------------------------------------------------------

# Words of a text, as the contract has them; lower() would also change other letters.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINES = rf"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select *, {_FOLDED.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")}
    as key
  from lines
), repeated as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 20
  group by key having count(distinct doc_id) >= 3
)
select doc_id, count(*) as n_lines,
       count(*) filter (keeper is not null and keeper <> doc_id) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos)
                       filter (keeper is null or keeper = doc_id), '')) as kept_sha256
from keyed left join repeated using (key) group by doc_id
"""

_NEAR = f"""
with recursive worded as (
  select doc_id, {_WORDS.replace("coalesce(text, '')", _FOLDED.format("coalesce(text, '')"))} as w
  from documents
), shingled as (
  select doc_id, unnest(case when len(w) = 0 then []
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end) as s
  from worded
), sets as (select distinct doc_id, s from shingled),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
-- Rarest first: of two linked sets the first tokens up to n - ceil(0.85 n) + 1 must meet.
ranked as (
  select doc_id, s, n, row_number() over (partition by doc_id order by df, s) as r
  from sets join sizes using (doc_id)
  join (select s, count(*) as df from sets group by s) using (s)
), firsts as (select doc_id, s, n from ranked where r <= n - cast(ceil(0.85 * n) as bigint) + 1),
pairs as (
  select distinct a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb
  from firsts a join firsts b on a.s = b.s and a.doc_id < b.doc_id
  where 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
), links as (
  select a, b from pairs join sets x on x.doc_id = a join sets y on y.doc_id = b and y.s = x.s
  group by a, b, na, nb having 100 * count(*) >= 85 * (na + nb - count(*))
), both_ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id, doc_id as other from documents
  union select r.doc_id, e.b from reach r join both_ways e on e.a = r.other
), component as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from component left join sizes using (doc_id)
"""

_NEXT = ", ".join(f"lead(word, {k}) over following as w{k}" for k in range(1, 8))
_MEASURED = rf"""
with texts as (select doc_id, coalesce(text, '') as t, {_WORDS} as w from documents),
lined as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select doc_id, unnest(string_split(t, chr(10))) as line from texts)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
), words as (
  select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from texts
), shared as (
  select doc_id, sum(n) as n_window_distinct from (
    select doc_id, count(distinct word) as n from words group by doc_id, (i - 1) // 1000
  ) group by doc_id
), windows as (
  select doc_id, i, concat_ws(' ', word, w1, w2, w3, w4, w5, w6, w7) as s
  from (select doc_id, i, word, {_NEXT} from words
        window following as (partition by doc_id order by i))
  where w7 is not null
), again as (
  select doc_id, i from windows
  join (select doc_id, s from windows group by doc_id, s having count(*) > 1) using (doc_id, s)
), repeats as (
  select doc_id, count(distinct k) as n_repeat_words
  from (select doc_id, unnest(range(i, i + 8)) as k from again) group by doc_id
), measured as (
  select doc_id, cast(len(w) as bigint) as n_words,
         cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
         cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper,
         length(regexp_replace(t, '[^A-Za-z]', '', 'g')) as n_letters,
         coalesce(n_window_distinct, 0) as n_window_distinct, len(list_distinct(w)) as n_distinct
  from texts left join lined using (doc_id) left join repeats using (doc_id)
  left join shared using (doc_id)
)"""
# The rules in the order of their bits, as conditions on what is measured.
_FAILS = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "upper_case": "100 * n_upper > 50 * n_letters",
    "word_length": "not (word_chars between 2 * n_words and 20 * n_words)",
    "few_distinct_words": "n_words >= 50 and 100 * n_distinct < 20 * n_words",
    "few_distinct_in_windows": "n_words >= 50 and 100 * n_window_distinct < 20 * n_words",
}


def _any_fails(rules: tuple[str, ...]) -> str:
    return " or ".join(f"({_FAILS[rule]})" for rule in rules)


def _rules_sql() -> str:
    policy = quality_rules.POLICIES[RULES_POLICY]
    return (
        f"{_MEASURED} select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,"
        f" {_any_fails(quality_rules.BASE)} as base_failed, not ({_any_fails(policy)}) as kept"
        " from measured"
    )


def _ablation_sql() -> str:
    policy = quality_rules.POLICIES[RULES_POLICY]
    parts = []
    for rule in quality_rules.RULES:
        others = tuple(other for other in policy if other != rule)
        alone = f"({_FAILS[rule]}) and not ({_any_fails(others)})" if rule in policy else "false"
        parts.append(
            f"select '{rule}' as rule, count(*) filter ({_FAILS[rule]}) as n_failed,"
            f" count(*) filter ({alone}) as n_only from measured"
        )
    return _MEASURED + " union all ".join(parts)


def oracle_sql() -> dict[str, str]:
    """For the operators that SQL can express; tests hold the others against brute force."""
    return {
        "op5_minhash_dedup": _NEAR,
        "op6_line_dedup": _LINES,
        "op10_quality_rules": _rules_sql(),
        "rules_ablation": _ablation_sql(),
        "op12_merkle_manifest": oracles.manifest(),
        "op13_vector_codes": oracles.vector_codes(),
    }

"""One query per operator, over whole tables, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from staymart.llm.common import table
from staymart.llm.embeddings import vector_groups
from staymart.llm.language import fit_languages, languages_of
from staymart.llm.lines import line_report
from staymart.llm.mixing import MIXTURE_SQL, mixture
from staymart.llm.packing import pieces
from staymart.llm.periodic_runs import run_report
from staymart.llm.quality_model import quality_scores, rule_ensemble_for
from staymart.llm.quality_rules import judged, rules_for
from staymart.llm.secrets import secret_scan
from staymart.llm.simhash import simhash_groups
from staymart.llm.spans import span_report
from staymart.llm.token_counts import token_counts
from staymart.llm.whitening import whitened_vectors

#: The vocabulary files that the queries use; any other place is a parameter of the operators.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark, sf_dir):
    return secret_scan(table(spark, sf_dir, "documents"))


@query
def op2_embedding_dedup(spark, sf_dir):
    return vector_groups(table(spark, sf_dir, "embeddings"))


@query
def op3_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return languages_of(docs, fit_languages(docs))


@query
def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, rule_ensemble_for(docs, sf_dir))


@query
def op8_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return judged(docs, rules_for(docs, sf_dir))


@query
def op9_simhash(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))


@query
def op5_mixing(spark, sf_dir):
    return mixture(table(spark, sf_dir, "documents"))


ORACLES["op5_mixing"] = MIXTURE_SQL


@query
def op7_packing(spark, sf_dir):
    return pieces(table(spark, sf_dir, "documents"), TOKENIZER, with_ids=False)


@query
def op10_line_dedup(spark, sf_dir):
    return line_report(table(spark, sf_dir, "documents"))


@query
def op11_substring_dedup(spark, sf_dir):
    return span_report(table(spark, sf_dir, "documents"))


@query
def op12_periodic_runs(spark, sf_dir):
    return run_report(table(spark, sf_dir, "documents"), periodic=True)


@query
def op13_whitening(spark, sf_dir):
    return whitened_vectors(table(spark, sf_dir, "embeddings"))

"""Registered queries of the training-data operators: name -> callable
(spark, sf_dir) -> DataFrame, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.documents import load_table, spread
from . import (arrow_tokens, bag_minhash, chat_collapse, decontaminate, fair_mix, fingerprints, importance_resample, line_dedup,
               line_frequency, secret_scan, token_alignment, url_templates, warc)

QUERIES = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _documents(spark, sf_dir, *columns):
    return spread(load_table(spark, sf_dir, "documents").select(*columns))


@register
def op3_decontaminate(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return decontaminate.report(docs, load_table(spark, sf_dir, "benchmark"))


@register
def op10_arrow_tokens(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return arrow_tokens.token_index(docs, tokenizer_file())


@register
def op5_line_frequency(spark, sf_dir):
    return line_frequency.report(_documents(spark, sf_dir, "doc_id", "text", "source"))


@register
def op7_line_dedup(spark, sf_dir):
    return line_dedup.report(_documents(spark, sf_dir, "doc_id", "text"))


@register
def op9_fair_mix(spark, sf_dir):
    return fair_mix.report(_documents(spark, sf_dir, "doc_id", "text", "source"))


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def labelled_pages(spark, sf_dir):
    """Pages with ``bad`` (1: of low quality or toxic) where the document
    that their url ends in the number of has a label."""
    pages = load_table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract("url", r"/([0-9]{1,18})(?:\.html|/)?(?:[?#].*)?$", 1)
    pages = pages.withColumn("doc_id", F.when(number != "", number).cast("bigint"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    labels = load_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return pages.join(labels, "doc_id", "left").select("page_id", "url", "bad")


@register
def op8_url_templates(spark, sf_dir):
    return url_templates.report(labelled_pages(spark, sf_dir), URL_RULES)


@register
def op6_secret_scan(spark, sf_dir):
    return secret_scan.report(_documents(spark, sf_dir, "doc_id", "text"))


@register
def op2_bag_minhash(spark, sf_dir):
    return bag_minhash.report(_documents(spark, sf_dir, "doc_id", "text"))


@register
def op1_chat_collapse(spark, sf_dir):
    return chat_collapse.render(load_table(spark, sf_dir, "conversations"))


@register
def op4_warc(spark, sf_dir):
    return warc.report(spread(load_table(spark, sf_dir, "pages")))


@register
def op11_importance_resample(spark, sf_dir):
    return importance_resample.report(_documents(spark, sf_dir, "doc_id", "text"), load_table(spark, sf_dir, "benchmark"))


@register
def op12_token_alignment(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return token_alignment.report(docs, tokenizer_file(), tokenizer_file("piece_bpe_32k.model"))


@register
def op13_fingerprints(spark, sf_dir):
    return fingerprints.edited_report(_documents(spark, sf_dir, "doc_id", "text"))

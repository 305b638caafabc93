"""The registered queries of this subpackage; their operators are in the modules beside it."""

from __future__ import annotations

import public_tokenizers

from tidemark.llm import oracles
from tidemark.llm.decontaminate import find_leaks
from tidemark.llm.exact import exact_dedup
from tidemark.llm.html_text import extract_main_text
from tidemark.llm.language import identify_languages
from tidemark.llm.merkle import dataset_manifest
from tidemark.llm.piece_bpe import encode_pieces
from tidemark.llm.quality import score_quality
from tidemark.llm.secrets import find_secrets
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.tokens import token_files
from tidemark.llm.topk import top_inner_products
from tidemark.llm.trie import prefix_trie
from tidemark.llm.warc import archive_round_trip
from tidemark.session import table

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op9_exact_dedup", """
    with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x from documents),
    d as (select doc_id, sha256(x) as text_sha256 from t),
    w as (select *, max(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size from d)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from w""")
def op9(spark, folder):
    return exact_dedup(table(spark, folder, "documents"))


@query("op3_token_files")
def op3(spark, folder):
    return token_files(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query("op4_sentencepiece")
def op4(spark, folder):
    return encode_pieces(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), end_id=2)


@query("op5_language")
def op5(spark, folder):
    return identify_languages(table(spark, folder, "documents"))


@query("op8_secrets")
def op8(spark, folder):
    return find_secrets(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op10_quality")
def op10(spark, folder):
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op1_simhash")
def op1(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


@query("op6_decontamination")
def op6(spark, folder):
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op2_warc")
def op2(spark, folder):
    return archive_round_trip(table(spark, folder, "pages"))


@query("op7_html_text")
def op7(spark, folder):
    return extract_main_text(table(spark, folder, "pages"))


@query("op12_merkle", oracles.merkle())
def op12(spark, folder):
    return dataset_manifest(table(spark, folder, "documents"))


@query("op13_prefix_trie", oracles.prefix_trie())
def op13(spark, folder):
    return prefix_trie(table(spark, folder, "conversations"))


@query("op11_top_k", oracles.TOP_K)
def op11(spark, folder):
    return top_inner_products(table(spark, folder, "embeddings"))

"""The one-pass round trip of byte-level BPE against the tiktoken library."""

import base64
import hashlib

import public_tokenizers as P
import tiktoken

from isobar.llm import bpe, queries

NAME = "byte_bpe_multi_50k.tiktoken"


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(NAME), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(rows):
    encode = library().encode_ordinary
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    out = []
    for r in rows:
        ids = encode(r.text or "")
        out.append((r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    return sorted(out, key=str)


def test_query_equals_the_library(spark, data, docs):
    assert sorted(map(tuple, queries.op3_bpe(spark, data).collect()), key=str) == expected(docs.select("doc_id", "text").collect())


def test_odd_rows(spark, odd, empty):
    assert sorted(map(tuple, bpe.round_trip(odd, P.path(NAME)).collect()), key=str) == expected(odd.select("doc_id", "text").collect())
    assert bpe.round_trip(empty, P.path(NAME)).collect() == []


def test_round_trip_is_encode_and_decode(spark, docs):
    some = docs.limit(40)
    back = {r.doc_id: (len(r.ids), hashlib.sha256(bytes(r.decoded)).hexdigest()) for r in bpe.decode(bpe.encode(some, P.path(NAME)), P.path(NAME)).collect()}
    assert {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in bpe.round_trip(some, P.path(NAME)).collect()} == back

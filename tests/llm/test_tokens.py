"""Operators on tokens, chats, pages and the pipeline, against the libraries and by round trips."""

import base64
import bisect
import hashlib
import json
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from isobar.llm import bpe, chat, html, packing, queries, rans
from isobar.llm.pretoken import PieceEncoder, split_spaced, split_words

NASTY = ["", "'s", "it's we're they'll 'tis  'd \n'really", "a\n\nb  c \t d   ", "  ", "\n\n x", "don't''s ''ll x'll'", "１２３ ab12cd 3.14 　x \xa0 y", "é Σας ΣΑΣ İx", "😀😀 a", "!!'s !'ve", " 're", "a'", "'", "<|endoftext|> x", "\x00\x1c a"]


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def mixed(spark, texts):
    rows = list(texts.items()) + [(10_000 + k, t) for k, t in enumerate([*NASTY, None])]
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)


def own(ranks_path):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(mixed, empty, odd):
    df, rows = mixed
    path = P.path("byte_bpe_multi_50k.tiktoken")
    library = own(path)
    for r in bpe.decode(bpe.encode(df, path), path).collect():
        assert r.ids == library.encode_ordinary(rows[r.doc_id] or "")
        assert bytes(r.decoded) == (rows[r.doc_id] or "").encode()
    assert bpe.encode(empty, path).count() == 0
    assert bpe.decode(bpe.encode(odd, path), path).count() == odd.count()


def test_perfect_hash_is_minimal():
    keys = [f"k{i}".encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert sorted(h.index.tolist()) == list(range(5000)) and h.find(keys) == list(range(5000))
    assert h.find([b"other", b""]) == [-1, -1] and bpe.PerfectHash([]).find([b"x"]) == [-1]


def test_merge_order_of_long_pieces():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ab": 258, b"aaaa": 259}
    library = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    for text in ("a" * 7, "aab" * 40, "b" * 9, "abab" * 30 + "a", "ba" * 500):
        assert bpe.merged(text.encode(), ranks) == library.encode_ordinary(text)


def library_ids(name, end):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_packing(mixed, empty, odd):
    df, rows = mixed
    ids = library_ids("word_bpe_49k.json", 1)
    got = packing.pack_documents(df, P.path("word_bpe_49k.json"), capacity=256).collect()
    pieces = {(i, p): ids(t)[s : s + 256] for i, t in rows.items() for p, s in enumerate(range(0, len(ids(t)), 256))}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == {(i, p): (256 * p, len(x), zlib.crc32(x.tobytes())) for (i, p), x in pieces.items()}
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(held) <= best_fit([r.length for r in got], 256)
    assert packing.pack_documents(empty, P.path("word_bpe_49k.json")).count() == 0
    assert packing.pack_documents(odd, P.path("word_bpe_49k.json")).select("doc_id").distinct().count() == odd.select("doc_id").distinct().count()


def best_fit(lengths, capacity):
    """Plain best fit of one piece after the other, longest first."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, x)
        gap = gaps.pop(k) if k < len(gaps) else capacity
        bisect.insort(gaps, gap - x)
    return len(gaps)


def test_plan_needs_no_more_than_best_fit():
    for seed, (mean, spread, n, capacity) in enumerate([(6, 1.2, 20_000, 4096), (5, 1, 20_000, 4096), (7, 0.5, 8000, 4096), (4, 2, 5000, 1000), (3, 1, 3000, 97), (8, 1, 500, 4096), (5, 0.2, 9000, 512)]):
        lengths = np.clip(np.random.default_rng(seed).lognormal(mean, spread, n).astype(int), 1, capacity)
        h = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
        assert sum(c for c, _ in packing.plan(h, capacity)) <= best_fit(lengths.tolist(), capacity)


def test_packing_with_clashing_columns(spark):
    table = spark.createDataFrame([(k, 0, 1 + k % 50) for k in range(300)], "doc_id long, piece int, length long").withColumn("salt", F.lit("s")).withColumn("rank", F.lit(1)).withColumn("_salt", F.lit(2))
    got = packing.pack(table, capacity=64).collect()
    assert len(got) == 300 and all(r.salt == "s" and r["rank"] == 1 and r._salt == 2 for r in got)


def test_packed_sequences_hold_the_tokens(spark, docs):
    some = docs.limit(20)
    cut = packing.pieces(some, P.path("word_bpe_49k.json"), capacity=512)
    placed = packing.pack(cut.drop("ids"), capacity=512)
    for r in packing.sequences(placed, cut).collect():
        assert sum(len(p.ids) // 4 for p in r.pieces) <= 512
        assert [p.offset for p in r.pieces] == np.cumsum([0] + [len(p.ids) // 4 for p in r.pieces])[:-1].tolist()


def test_plan_keeps_every_length():
    rng = np.random.default_rng(0)
    for n in (1, 7, 300, 20_000):
        lengths = np.clip(rng.lognormal(5, 1.5, n).astype(int), 1, 1024)
        h = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
        back = {}
        for count, held in packing.plan(h, 1024):
            assert sum(k * c for k, c in held) <= 1024
            for k, c in held:
                back[k] = back.get(k, 0) + count * c
        assert back == h
    assert packing.plan({}, 64) == [] and packing.plan({1: 10**12}, 64) == [(15625000000, [(1, 64)])]


def test_token_file_round_trip(spark, mixed, empty, tmp_path):
    df, rows = mixed
    ids, at = library_ids("byte_bpe_50k.json", 2), 0
    path = str(tmp_path / "file")
    rans.write(df, path, P.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in rans.read(spark, path).collect()}
    for i in sorted(rows):
        want = ids(rows[i])
        assert (got[i].start, got[i].n_tokens, bytes(got[i].ids)) == (at, len(want), want.tobytes())
        at += len(want)
    rans.write(empty, str(tmp_path / "none"), P.path("byte_bpe_50k.json"))
    assert rans.read(spark, str(tmp_path / "none")).count() == 0
    bad = spark.read.parquet(f"{path}/blocks").withColumn("crc32", F.col("crc32") + 1)
    bad.write.parquet(str(tmp_path / "bad" / "blocks"))
    spark.read.parquet(f"{path}/frequencies").write.parquet(str(tmp_path / "bad" / "frequencies"))
    with pytest.raises(Exception, match="damaged"):
        rans.read(spark, str(tmp_path / "bad")).collect()


def test_token_file_of_many_small_parts(spark, mixed, tmp_path, monkeypatch):
    """Tasks then read several written files each, not in order of ids; rows without an id come first."""
    df, rows = mixed
    monkeypatch.setattr(rans, "BLOCK_TOKENS", 500)
    df = df.union(spark.createDataFrame([(None, "no id"), (None, None)], "doc_id long, text string"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rans.write(df, str(tmp_path / "file"), P.path("byte_bpe_50k.json"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spark.read.parquet(str(tmp_path / "file" / "blocks")).select("part").distinct().count() > 15
    got = rans.read(spark, str(tmp_path / "file")).collect()
    assert len(got) == len(rows) + 2
    ids = library_ids("byte_bpe_50k.json", 2)
    at = sum(len(ids(t)) for t in ("no id", None))
    assert {r.start for r in got if r.doc_id is None} <= set(range(at))
    got = {r.doc_id: r for r in got}
    for i in sorted(rows):
        want = ids(rows[i])
        assert (got[i].start, bytes(got[i].ids)) == (at, want.tobytes())
        at += len(want)


def test_blocks_and_checkpoints():
    rng = np.random.default_rng(0)
    blocks = [rng.choice(900, size=n, p=rng.dirichlet(np.ones(900) * 0.1)) for n in (1, 127, 128, 129, 40_000, 5)]
    table = rans.Frequencies(*np.unique(np.concatenate(blocks), return_counts=True))
    coded = rans.encode_blocks(blocks, table)
    back = rans.decode_blocks([(len(b), c[0], c[1]) for b, c in zip(blocks, coded, strict=True)], table)
    assert all((a == b).all() for a, b in zip(blocks, back, strict=True))
    width = 8 + 8 * rans.LANES
    for k in range(len(coded[4][2]) // width):
        skip = (k + 1) * rans.CHECKPOINT * rans.LANES
        rest = rans.decode_from(coded[4][2][k * width : (k + 1) * width], coded[4][1], 40_000 - skip, table)
        assert (rest == blocks[4][skip:]).all()


def test_blocks_are_read_from_all_checkpoints(monkeypatch):
    rng = np.random.default_rng(1)
    size = rans.CHECKPOINT * rans.LANES
    blocks = [rng.integers(0, 700, n) ** 2 // 700 for n in (5, 3 * size, size, 10 * size + 77, 1, size + 1, 2 * size - 1)]
    table = rans.Frequencies(*np.unique(np.concatenate(blocks), return_counts=True))
    coded = rans.encode_blocks(blocks, table)
    assert [len(rans.stretches(len(b), *c)) for b, c in zip(blocks, coded, strict=True)] == [1, 3, 1, 11, 1, 2, 2]
    for together in (1, 4, 256):
        monkeypatch.setattr(rans, "STRETCHES", together)
        back = rans.decoded([(len(b), *c) for b, c in zip(blocks, coded, strict=True)], table)
        assert all(np.array_equal(a, b) for a, b in zip(blocks, back, strict=True))


def test_a_long_document_among_short_ones(spark, tmp_path):
    """A block far longer than others is coded by itself: arrays aren't padded to it."""
    text = " ".join(f"w{k % 5003} x{k}" for k in range(150_000))
    rows = [(k, f"short text {k}") for k in range(40)] + [(20_000, text), (20_001, "after it")]
    rans.write(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), str(tmp_path / "file"), P.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in rans.read(spark, str(tmp_path / "file")).collect()}
    ids = library_ids("byte_bpe_50k.json", 2)
    assert len(ids(text)) > 4 * rans.BLOCK_TOKENS
    assert all(bytes(got[i].ids) == ids(t).tobytes() for i, t in rows)


@pytest.mark.parametrize(("split", "name"), [(split_spaced, "byte_bpe_50k.json"), (split_words, "word_bpe_49k.json")])
def test_splits_in_small_chunks(split, name, monkeypatch):
    seen = []
    monkeypatch.setattr("isobar.llm.pretoken.CHUNK_CHARS", 7)
    encoder = PieceEncoder(split, lambda p: [(seen.append(x) or len(seen),) for x in p], known=3)
    sizes = [n for _, _, o in encoder.batches([t.lower() for t in NASTY]) for n in np.diff(o)]
    assert len(sizes) == len(NASTY) and sizes[0] == 0


def test_chat_round_trip(spark):
    nasty = ["\\", "\\\\", "###", "####", "\\###", "</turn>\n### user:\nx</turn>\n", "</turn", "a\\</turn>b", "", "é\n### ", "#### ##", ":\n", None]
    rows = [(i, j, r, x) for i, x in enumerate(nasty) for j, r in enumerate(["user", "assistant", x])]
    df = spark.createDataFrame(rows + [(50, 0, None, None), (None, 1, "assistant", "z"), (50, 0, None, None)], "conv_id long, turn long, role string, text string").withColumn("at", F.lit("clash"))
    back = {r.conv_id: r for r in chat.read_back(chat.conversations(chat.formatted_turns(chat.canonical_turns(df)))).collect()}
    for i, x in enumerate(nasty):
        x = x or ""
        assert [(t.role, t.text) for t in back[i].turns] == [("user", x), ("assistant", x), (x, x)]
        assert back[i].learned == [x]
    assert len(back[50].turns) == 2 and back[None].learned == ["z"]


def test_layouts(spark):
    records = [{"prompt": "a", "completion": "b"}, {"instruction": "i", "input": "n", "output": "o"}, {"messages": [{"role": "human", "content": "h"}, {"role": "gpt", "content": "g"}]}, {"conversations": [{"from": "human", "value": "q"}], "extra": {"x": 1}}, {"x": 1}, {"prompt": None, "completion": "c"}, [1], {"turn": 3, "role": "user", "text": "t"}, {"question": "q", "answer": "a", "id": 7, "meta": {"k": [1]}}, {"messages": []}]
    records += [{"messages": [{"role": "user", "content": "x"}], f"f{k}": k} for k in range(300)]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(1009, "{bad"), (1010, None)], "conv_id long, record string")
    got = sorted(map(tuple, chat.turns_of_json(df).collect()))
    assert got == [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (1, 0, "user", "i\n\nn"), (1, 1, "assistant", "o"), (2, 0, "user", "h"), (2, 1, "assistant", "g"), (3, 0, "user", "q"), (5, 0, "user", ""), (5, 1, "assistant", "c"), (7, 3, "user", "t"), (8, 0, "user", "q"), (8, 1, "assistant", "a")] + [(k, 0, "user", "x") for k in range(10, 310)]
    assert chat.turns_of_json(df.limit(0)).count() == 0
    assert chat.schema_fingerprint(["b", "a"]) == chat.schema_fingerprint(["a", "b", "a"])


def test_conversations_query(spark, data):
    got = {r.conv_id: r for r in queries.op7_chat(spark, data).collect()}
    own_turns = {}
    for r in spark.read.parquet(f"{data}/conversations.parquet").orderBy("conv_id", "turn").collect():
        own_turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    own_turns[-7] = [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, turns in own_turns.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        assert (got[i].n_turns, got[i].turns_sha256, got[i].loss_chars, got[i].loss_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned))


PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><header class="site-header"><h1>Site</h1></header><nav><a href=x>a b</a></nav>
<div id="content"><h2>Title &amp; more</h2><p>First paragraph with <b>a fair</b> number of   words to read, so it's content.<p>Short.<br>Line two
<div class="share-buttons">Share this</div><p>Another paragraph with enough words to count as proper content here.</p></div>
<div class="comments"><p>I think this article is nice and has many words inside of it.</p></div><aside>Related</aside><form><label>Email</label></form><footer>&copy; 2020</footer>"""


def test_main_text(spark, data):
    assert " ".join(b.text for b in html.main_blocks(PAGE)) == "Title & more First paragraph with a fair number of words to read, so it's content. Short. Line two Another paragraph with enough words to count as proper content here."
    rows = [(1, None), (2, ""), (3, "<"), (4, "<p"), (5, PAGE), (5, PAGE), (None, "<p>" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    got = html.extract(df).collect()
    assert [len(r.text) > 0 for r in sorted(got, key=lambda r: (r.page_id is None, r.page_id or 0))] == [False] * 4 + [True, True, False]
    for r in spark.read.parquet(f"{data}/pages.parquet").limit(50).collect():
        import re
        from html import unescape

        inner = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        assert " ".join(b.text for b in html.main_blocks(r.html)) == " ".join(unescape(re.sub(r"<[^>]*>", " ", inner)).split())


def test_cut_is_minimal():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(1, 9))
        a, b = rng.integers(0, 6, n).astype(float), rng.integers(0, 6, n).astype(float)
        edges = [(i, j, float(rng.integers(1, 5))) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4]
        cost = lambda s: sum(b[i] if s[i] else a[i] for i in range(n)) + sum(w for i, j, w in edges if s[i] != s[j])  # noqa: B023, E731
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(html.minimum_cut(list(a), list(b), edges)) == best


def test_pipeline(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, seen, data)
        assert after.columns == docs.columns
        ids = {r.doc_id for r in seen.select("doc_id").collect()}
        left = {r.doc_id for r in after.select("doc_id").collect()}
        assert left <= ids, name
        seen = after
    packed = corpus_pipeline.run(spark, data)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in seen.select("doc_id").collect()}

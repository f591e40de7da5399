"""Tokenizer alignment against a plain count of overlapping byte ranges."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
import tokenizers

from feedbacklens.llm import align
from feedbacklens.llm.bpe import Merges
from feedbacklens.llm.byte_bpe import _Ranked, read_ranks

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def sides():
    a = tokenizers.Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def plain(texts, sides):
    """Every link by comparing every A token with every B token of a text."""
    letters = align.byte_of_letter()
    rows = []
    for text in texts:
        ids = ([], [])
        if text:
            whole = b" " + text.encode()
            a, b = sides[0].encode(" " + text, add_special_tokens=False), sides[1].encode(text)
            parts = ([bytes(letters[c] for c in t) for t in a.tokens],
                     [align.piece_bytes(sides[1].id_to_piece(i)) for i in b])
            if all(b"".join(p) == whole for p in parts):
                ids = (a.ids, b)
        spans = []
        for side, row in enumerate(ids):
            at, found = 0, []
            for i, one in enumerate(row):
                found.append((at, at + len(parts[side][i]), one))
                at = found[-1][1]
            spans.append(found)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        ends = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(x[2]) for x in side if start < x[1] <= end) for side in spans))
            start = end
        rows.append((len(ids[0]), len(ids[1]), len(ends), links, ";".join(groups)))
    count = Counter(link for row in rows for link in row[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(n_a, n_b, n_groups, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(shown.encode()).hexdigest() if shown else "")
            for n_a, n_b, n_groups, links, shown in rows]


TEXTS = [None, "", " ", "a", "the cat sat", "the cat sat", "The  cat\n\tsat", "▁x", "naïve café", "日本語 text 𝄞",
         "<|endoftext|> <s> </s> <unk> <0x41>", "\x00 \x01", "aaaa" * 30, "x " * 200, "it's we're I'd 123 4,567.89",
         "Ünïcödé " * 20, "ha" * 100, "tab\tand\r\nlines\n\n\n"]


@pytest.mark.parametrize(("block", "fanin", "ranks"), [(40, 4, RANKS), (1_000_000, 256, None)])
def test_against_plain(spark, sides, block, fanin, ranks):
    """Small blocks and fan-in make a tree of several levels; names clash; a text repeats often."""
    texts = [*TEXTS, *["the cat sat on the mat"] * 15]
    rows = [(None if i % 5 == 0 else 7, t, i, "x", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, radix int, _block string, N_A int").repartition(3)
    got = align.align(docs, *PATHS, ranks=ranks, block_bytes=block, fanin=fanin)
    assert [c for c in got.columns if c.lower() == "n_a"] == ["n_a"] and "text" not in got.columns
    found = {r.radix: r for r in got.collect()}
    assert len(found) == len(texts)
    for row, expected in zip(rows, plain(texts, sides)):
        r = found[row[2]]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == expected, row[1]
        assert (r.doc_id, r._block) == (row[0], "x")


def test_empty_table_and_long_text(spark, sides):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(none, *PATHS).count() == 0
    long = "over and over again, " * 40_000
    r = align.align(spark.createDataFrame([(1, long)], none.schema), *PATHS, ranks=RANKS, block_bytes=1000).first()
    assert r.n_a == len(sides[0].encode(" " + long, add_special_tokens=False).ids) and r.n_b == len(sides[1].encode(long))


def test_ranks_give_the_ids_of_the_vocabulary(sides):
    """Each token is made by the same last merge on both sides, so every text is; classes agree up to U+024F."""
    import json

    import tiktoken

    with open(PATHS[0]) as file:
        merges = json.load(file)["model"]["merges"]
    with open(RANKS, "rb") as file:
        ranks = read_ranks(file.read())
    letters = align.byte_of_letter()
    word = lambda t: bytes(letters[c] for c in t)
    listed = [tuple(map(word, m if isinstance(m, list) else m.split(" "))) for m in merges]
    assert [ranks[x + y] for x, y in listed] == sorted(ranks[x + y] for x, y in listed)
    single = {t: tuple(bytes([c]) for c in t) for t in ranks}
    rules = _Ranked(ranks)

    class Below:
        """Only merges that come before a token's own."""

        def get(self, pair):
            found = rules.get(pair)
            return found if found and found[0] < self.limit else None

    below = Below()
    by_merge = Merges(below, single)
    for x, y in listed:
        below.limit = ranks[x + y]
        assert by_merge.merge(single[x + y]) == [x, y]
    coder = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for c in map(chr, range(0x250)):
        text = f" {c}a {c}{c}  {c}1'{c} .{c}\n{c} {c}"
        assert coder.encode_ordinary(text) == sides[0].encode(text, add_special_tokens=False).ids


def test_packed_numbers_and_merge():
    import numpy as np

    runs = [(np.array([5, 1 << 40, (1 << 40) + 3]), np.array([1, 2, 3])), (np.array([(1 << 40) + 3]), np.array([10])),
            (np.array([], np.int64), np.array([], np.int64))]
    packed = [align.pack_run(*run) for run in runs]
    assert [[x.tolist() for x in align.unpack_run(p)] for p in packed] == [[x.tolist() for x in run] for run in runs]
    pairs, counts = align.merged(packed)
    assert pairs.tolist() == [5, 1 << 40, (1 << 40) + 3] and counts.tolist() == [1, 2, 13]
    assert align.marked(pairs, counts).tolist() == [3, 4, 27]

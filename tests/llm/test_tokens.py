"""URL filter, token counts and byte-level BPE against rules, libraries and round trips."""

import random
from hashlib import sha256

import public_tokenizers
import pytest

from feedbacklens.llm import byte_bpe, token_count, url_filter

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SIGNS = " \n\t  ab'sreT.,!é漢字🙂0१²́\r=ΣİA\x85\x1c"


def random_texts(n, seed):
    draw = random.Random(seed)
    parts = [*SIGNS, "<|endoftext|>", "the ", "token's", "   "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(n)]
    return [*texts, "", "a" * 5000, "=" * 3000, " " * 2000 + "x", "word " * 4000]


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(RANKS, "rb") as file:
        ranks = byte_bpe.read_ranks(file.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder_agrees_with_library(library):
    texts = random_texts(3000, 1)
    with open(RANKS, "rb") as file:
        encoder = byte_bpe.encoder_for(file.read(), public_tokenizers.PATTERN)
    for text, ids in zip(texts, encoder.encode_all(texts)):
        assert ids == library.encode_ordinary(text), text
        assert encoder.decode(ids) == text.encode()


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED", 3)
    with open(RANKS, "rb") as file:
        encoder = byte_bpe.TextEncoder(byte_bpe.read_ranks(file.read()), public_tokenizers.PATTERN)
    for text in random_texts(60, 2)[:60]:
        assert encoder.encode_all([text, text]) == [library.encode_ordinary(text)] * 2


def test_append_and_edit(library):
    with open(RANKS, "rb") as file:
        encoder = byte_bpe.PrefixEncoder(byte_bpe.read_ranks(file.read()))
    draw = random.Random(3)
    encoder.resume(b"tokenization", 0)
    for _ in range(200):
        if draw.random() < 0.5:
            encoder.append(bytes(draw.choices(b"thereinzq", k=draw.randint(0, 4))))
        else:
            start = draw.randint(0, len(encoder.text))
            encoder.edit(start, min(len(encoder.text), start + draw.randint(0, 3)), bytes(draw.choices(b"aeth", k=2)))
        assert encoder.tokens() == library._encode_single_piece(encoder.text)


def test_encode_and_decode_tables(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (3, "Hello  world\n", "z"), (3, "Hello  world\n", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _digest string")
    ids = byte_bpe.encode_texts(docs, RANKS)
    got = byte_bpe.decode_ids(ids, RANKS).orderBy("doc_id").collect()
    assert all(r.round_trip for r in got)
    assert [r.token_ids for r in got] == [library.encode_ordinary(t or "") for _, t, _ in rows]
    assert [bytes(r.decoded) for r in got] == [(t or "").encode() for _, t, _ in rows]
    digest = byte_bpe.encoded_digest(docs, RANKS).orderBy("doc_id").collect()
    assert [r.n_tokens for r in digest] == [len(r.token_ids) for r in got]
    assert digest[0].ids_sha256 == digest[0].decoded_sha256 == digest[1].ids_sha256
    assert [r["_digest"] for r in digest] == ["x", "y", "z", "z"]
    assert byte_bpe.encoded_digest(docs.limit(0), RANKS).count() == 0


def test_counts_agree_with_library(monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    with open(WORDS, "rb") as file:
        counter = token_count.counter_for(file.read())
    for size in (3, 17, 1 << 16):
        monkeypatch.setattr(token_count, "CHUNK", size)
        for text in random_texts(700, size):
            assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), ascii(text)


def test_maps_compose_in_any_order():
    with open(WORDS, "rb") as file:
        counter = token_count.counter_for(file.read())
    draw = random.Random(4)
    for text in random_texts(100, 5)[:100]:
        cuts = sorted(draw.randint(0, len(text)) for _ in range(3))
        a, b, c = (counter.chunk(text[i:j]) for i, j in zip([0, *cuts[:2]], cuts))
        left = counter.compose(counter.compose(a, b), c)
        assert left == counter.compose(a, counter.compose(b, c))


def test_states_are_made_anew(monkeypatch):
    with open(WORDS, "rb") as file:
        counter = token_count.counter_for(file.read())
    words = [b"tokenization", b"there", b"thereof", b"zzzq"]
    expected = [counter.transducer.count(w) for w in words]
    monkeypatch.setattr(token_count, "STATES", 2)
    assert [counter.transducer.count(w) for w in words * 2] == expected * 2


def test_count_table(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "Ünïcode x", 5)], "doc_id long, text string, N_TOKENS int")
    got = token_count.count_tokens(docs, WORDS, limit=1).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.over_limit) for r in got] == [(0, False), (0, False), (11, True)]
    assert got[0].n_tokens == got[1].n_tokens == 0
    assert token_count.count_tokens(docs.limit(0), WORDS).count() == 0


URLS = [
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("no scheme casino", "", "", None, "block"),
    ("http://A.Example.NET/en/1?x", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://a.example.net/de/1", "a.example.net", "/de/1", "net/", "block"),
    ("http://net?x", "net", "", None, "allow"),
    ("http://notnet/a", "notnet", "/a", None, "allow"),
    ("http://x.org/fr/casino", "x.org", "/fr/casino", "org/fr/", "allow"),
    ("http://x.org/en/casino", "x.org", "/en/casino", None, "block"),
    ("http://x.org/en/casinos", "x.org", "/en/casinos", None, "allow"),
    ("http://free.org/free", "free.org", "/free", None, "allow"),
    ("http://free.org/cheap", "free.org", "/cheap", None, "block"),
    ("a://b://c/d#e", "b:", "//c/d", None, "allow"),
    ("http://EXAMPLE.com/de/#", "example.com", "/de/", "example.com/de/", "block"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u[0], "kept") for i, u in enumerate(URLS)], "page_id int, url string, _hits string")
    got = url_filter.judge_urls(pages.union(pages)).orderBy("page_id").collect()
    assert [(r.url, r.host, r.path, r.rule, r.verdict) for r in got[::2]] == URLS
    assert {r["_hits"] for r in got} == {"kept"}
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_terms_are_counted_by_boundary():
    terms = (("casino", 100), ("free", 50), ("win", 50))
    assert url_filter.count_terms("casino/casino-free.freewin", terms, 100) == (2, 1, 150)
    assert url_filter.count_terms("xcasino casino9 ", terms, 100) == (0, 0, 0)
    assert url_filter.count_terms(None, terms, 100) == (0, 0, 0)


def test_no_rules(spark):
    page = spark.createDataFrame([("http://x.net/",)], "url string")
    row = url_filter.judge_urls(page, rules=[], terms={}).first()
    assert (row.rule, row.verdict) == (None, "allow")


def test_neighbours_are_told_without_merging(library, monkeypatch):
    with open(RANKS, "rb") as file:
        encoder = byte_bpe.PrefixEncoder(byte_bpe.read_ranks(file.read()))
    monkeypatch.setattr(byte_bpe.Merges, "merge", None)
    for text in random_texts(300, 6):
        for piece in byte_bpe.splitter(public_tokenizers.PATTERN)(text):
            assert encoder.encode(piece.encode()) == library._encode_single_piece(piece.encode()), piece


@pytest.mark.parametrize("rising", [True, False])
def test_fit_agrees_with_merging(rising):
    draw = random.Random(7)
    for _ in range(60):
        tokens = [b"a", b"b", b"c"]
        for _ in range(25):
            whole = b"".join(draw.choices(tokens if rising else tokens[:3], k=draw.randint(2, 2 if rising else 4)))
            if whole not in tokens:
                tokens.append(whole)
        if not rising:
            draw.shuffle(tokens)
        encoder = byte_bpe.PrefixEncoder({token: rank for rank, token in enumerate(tokens)})
        for left in tokens:
            for right in tokens:
                merged = encoder.merges.merge([bytes([byte]) for byte in left + right])
                assert encoder.fit(left, right) == (merged == [left, right]), (tokens, left, right)


def test_limits_of_memory_change_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    with open(RANKS, "rb") as file:
        encoder = byte_bpe.PrefixEncoder(byte_bpe.read_ranks(file.read()))
    for text in random_texts(100, 8):
        assert encoder.encode(text.encode()) == library._encode_single_piece(text.encode()) if text else True
    assert sum(map(len, encoder.fits.values())) <= 5
    assert sum(len(state.next) for state in encoder.states.values()) <= 5


def test_digests_write_and_decode_each_piece_once(library, monkeypatch):
    decoded = []
    plain = byte_bpe.TextEncoder.decode
    monkeypatch.setattr(byte_bpe.TextEncoder, "decode", lambda self, ids: decoded.append(1) or plain(self, ids))
    texts = [*random_texts(200, 9), *random_texts(200, 9)] * 2
    with open(RANKS, "rb") as file:
        encoder = byte_bpe.DigestEncoder(byte_bpe.read_ranks(file.read()), public_tokenizers.PATTERN)
    for text, row in zip(texts, encoder.digest_all(texts), strict=True):
        ids = library.encode_ordinary(text)
        assert row == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                       sha256(text.encode()).hexdigest()), text
    assert len(decoded) == len({piece for text in texts for piece in encoder.pieces(text)})


def test_digests_of_a_pattern_with_empty_matches():
    with open(RANKS, "rb") as file:
        encoder = byte_bpe.DigestEncoder(byte_bpe.read_ranks(file.read()), "b*")
    ids = [encoder.encoder.ranks[b"bb"], encoder.encoder.ranks[b"b"]]
    assert list(encoder.digest_all(["abbab", "aaa"])) == [
        (2, sha256(f"{ids[0]} {ids[1]}".encode()).hexdigest(), sha256(b"bbb").hexdigest()),
        (0, sha256().hexdigest(), sha256().hexdigest())]

"""Hand-made cases of the text functions and preparation operators."""

import pytest
from pyspark.sql import Row, functions as F

from feedbacklens.functions import matching, text as T
from feedbacklens.operators import batches, keyphrases, lexical, prepare, stories, titles, vocab
from feedbacklens.sources import readers


def one(spark, value, expr, column="x", kind="string"):
    return spark.createDataFrame([(value,)], f"{column} {kind}").select(expr.alias("y")).first().y


@pytest.mark.parametrize("key,expected", [(" 12a", 12), ("", None), (None, None), ("abc", None)])
def test_digits_key(spark, key, expected):
    assert one(spark, key, T.digits_key(F.col("x"))) == expected


def test_blank_keys_are_dropped(spark):
    df = spark.createDataFrame(
        [("7", "a\nb", " Fees "), ("", "x", "y"), (None, "x", "y")],
        "sno string, feedback string, label string")
    assert prepare.clean_feedback(df).collect() == [Row(sno=7, feedback="a b", label="fees")]


def test_concept_rows_ignore_key_columns_and_stack_files(spark):
    a = spark.createDataFrame([("1", "2019", "fees", 1)], "sno string, date string, issue string, `Too High` int")
    b = spark.createDataFrame([("2", "2019", "fees", 0, 1)],
                              "sno string, date string, issue string, `Too High` int, Slow int")
    rows = prepare.concept_rows(prepare.append([a, b]))
    assert sorted(map(tuple, rows.collect())) == [(1, "fees", "too high"), (2, "fees", "slow")]


def test_empty_concepts_leave_all_feedback_uncoded(spark):
    feedback = spark.createDataFrame([(1, "a", "l"), (2, "b", "l")], "sno long, feedback string, label string")
    none = spark.createDataFrame([], "sno long, concept string")
    assert prepare.uncoded(feedback, none).count() == 2
    assert prepare.coded(feedback, none).count() == 0


def test_split_is_a_partition(spark):
    rows = prepare.train_val_split(spark.range(10_000), prepare.hash_split("id"))
    counts = dict(map(tuple, rows.groupBy("split").count().collect()))
    assert sum(counts.values()) == 10_000 and 9_300 < counts["train"] < 9_700


@pytest.mark.parametrize("line,expected", [
    ("", ""), ("foo", "foo ."), ("foo.", "foo."), ("foo -- ", "foo  ."),
    ("a @highlight b", "a @highlight b"), ("@highlight", "@highlight"), ("foo”", "foo”")])
def test_story_line(spark, line, expected):
    assert one(spark, line, stories.story_lines(F.col("x"))) == [expected]


def test_story_round_trip(spark):
    df = spark.createDataFrame([(1, "First Line\nsecond.", "Too slow")], "id int, feedback string, concept string")
    row = stories.parse_stories(stories.make_stories(df)).first()
    assert row.article == "first line . second."
    assert row.abstract == "<s> too slow . </s>"
    assert stories.make_stories(df, "scoring").first().story.endswith(T.CONCEPT_PLACEHOLDER)


def test_story_without_highlight(spark):
    row = stories.parse_stories(spark.createDataFrame([("a\nb",)], "story string")).first()
    assert (row.article, row.abstract) == ("a . b .", "")


def test_priority_lookup_prefers_a_and_reports_missing(spark):
    ids = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "k string")
    a = spark.createDataFrame([("k1", "A1")], "k string, v string")
    b = spark.createDataFrame([("k1", "B1"), ("k2", "B2")], "k string, v string")
    rows = {r.k: (r.v, r.store) for r in stories.priority_lookup(ids, a, b, "k", "v").collect()}
    assert rows == {"k1": ("A1", "a"), "k2": ("B2", "b"), "k3": (None, None)}
    with pytest.raises(Exception, match="neither store"):
        stories.priority_lookup(ids, a, b, "k", "v", require=True).collect()


VOCAB = [("[UNK]", 0), ("[PAD]", 1), ("[START]", 2), ("[STOP]", 3), ("the", 4), ("cat", 5)]


@pytest.fixture
def small_vocab(spark):
    return spark.createDataFrame(VOCAB, "word string, id int")


def test_encode_unknown_words(spark, small_vocab):
    df = spark.createDataFrame(
        [(1, "the dog saw the dog", "<s> dog sat . </s>"), (2, "", "")], "k int, article string, abstract string")
    rows = {r.k: r for r in vocab.encode(df, small_vocab, 6, "k", 4, 3).collect()}
    assert rows[1].enc_input == [4, 0, 0, 4]
    assert rows[1].enc_input_extend_vocab == [4, 6, 7, 4]
    assert rows[1].article_oovs == ["dog", "saw"]
    assert rows[1].dec_input == [2, 0, 0] and rows[1].target == [6, 0, 0]
    assert rows[2].enc_len == 0 and rows[2].dec_input == [2] and rows[2].target == [3]


@pytest.mark.parametrize("n,inp,target", [
    (1, [2, 5], [5, 3]), (2, [2, 5, 5], [5, 5, 3]), (3, [2, 5, 5], [5, 5, 5])])
def test_decoder_limits(spark, small_vocab, n, inp, target):
    df = spark.createDataFrame([(1, "the", f"<s> {'cat ' * n}</s>")], "k int, article string, abstract string")
    row = vocab.encode(df, small_vocab, 6, "k", 9, 3).first()
    assert (row.dec_input, row.target) == (inp, target)


def test_decode_is_inverse_and_rejects_bad_ids(spark, small_vocab):
    df = spark.createDataFrame([(1, [4, 6, 3, 5], ["dog"]), (2, [3], [])], "k int, ids array<int>, oovs array<string>")
    rows = dict(map(tuple, vocab.decode_ids(df, small_vocab, 6, "k", "ids", "oovs").collect()))
    assert rows == {1: ["the", "dog"], 2: []}
    bad = spark.createDataFrame([(1, [9], ["dog"])], "k int, ids array<int>, oovs array<string>")
    with pytest.raises(Exception, match="no word for id"):
        vocab.decode_ids(bad, small_vocab, 6, "k", "ids", "oovs").collect()


def test_highlight(spark, small_vocab):
    df = spark.createDataFrame([(1, "the dog", "dog cat bird")], "k int, article string, abstract string")
    row = vocab.highlight_oovs(df, small_vocab, 6, "k").first()
    assert row.article == "the __dog__" and row.abstract == "__dog__ cat !!__bird__!!"


def test_vocab_file_validation(spark):
    lines = lambda *x: spark.createDataFrame([(v, i) for i, v in enumerate(x)], "value string, place int")
    good = vocab.vocab_from_lines(lines("zeta 5", "alpha 5", "c", "d 1 2", "b 7"), 6)
    assert {(r.word, r.id) for r in good.collect() if r.id >= 4} == {("zeta", 4), ("alpha", 5)}
    many = vocab.vocab_from_lines(lines(*[f"w{i} 1" for i in range(300)]))
    assert {r.word: r.id for r in many.collect() if r.id >= 4} == {f"w{i}": i + 4 for i in range(300)}
    with pytest.raises(Exception, match="reserved word"):
        vocab.vocab_from_lines(lines("[PAD] 5")).collect()
    with pytest.raises(Exception, match="duplicated word"):
        vocab.vocab_from_lines(lines("a 5", "a 4")).collect()


def test_padding_keeps_prefix(spark):
    df = spark.createDataFrame(
        [(i, i, list(range(4, 4 + i)), ["w"] * (i % 3)) for i in range(1, 40)],
        "k long, enc_len int, enc_input array<int>, article_oovs array<string>")
    df = df.select("*", F.col("enc_input").alias("enc_input_extend_vocab"), F.array(F.lit(2)).alias("dec_input"),
                   F.lit(1).alias("dec_len"), F.array(F.lit(3)).alias("target"))
    rows = batches.pad_batches(batches.length_batches(df, "k", 4, 3), 5).collect()
    assert len(rows) == 39
    for r in rows:
        assert r.enc_batch[:r.enc_len] == r.enc_input and set(r.enc_batch[r.enc_len:]) <= {1}
        assert sum(r.enc_padding_mask) == r.enc_len and len(r.enc_batch) == r.max_enc_len
        assert r.dec_batch == [2, 1, 1, 1, 1] and r.dec_padding_mask == [1, 0, 0, 0, 0]


def test_keyphrases(spark):
    df = spark.createDataFrame([(1, "The red car and the fast red bike, a car.")], "k int, t string")
    rows = keyphrases.keyphrases(df, "k", "t").orderBy("rank").collect()
    assert [(r.phrase, r.score) for r in rows] == [
        ("fast red bike", 8.5), ("red car", 4.0), ("car", 1.5)]


def test_candidates(spark):
    text = "John wants a faster checkout lane at night. ok fine . The clerk was very helpful today! no"
    df = spark.createDataFrame([(1, "l", "feed", text)], "k int, label string, feedback string, generated string")
    rows = keyphrases.concept_candidates(df, "k", ["John"]).orderBy("place").collect()
    assert [r.concept for r in rows] == ["wants a faster checkout lane at night", "The clerk was very helpful today"]


def test_title_removal(spark):
    df = spark.createDataFrame([
        (1, "bus service", "bus service is always late in the morning", "The MRT and BUS are late"),
        (2, "bus service", "the staff on my bus were kind", "x"),
        (3, "bus service", "bus service late now", "x"),
    ], "k int, label string, concept string, feed string")
    rows = {r.k: r.concept for r in titles.remove_title_text(df, 90).collect()}
    assert rows == {1: "is always late in the morning", 2: "the staff on my bus were kind"}


def test_lcs():
    assert matching.lcs_length("kitten", "sitting") == 4
    assert matching.lcs_length([], ["a"]) == 0
    assert matching.lcs_length("a b c d".split(), "b d x".split()) == 2


def test_spelling_and_lemmas(spark):
    words = spark.createDataFrame([("teh",), ("cars",), ("zzzz",), ("the",)], "word string")
    entries = spark.createDataFrame([("the", 9), ("tea", 3), ("car", 5)], "word string, cnt long")
    fixed = dict(map(tuple, lexical.correct_words(words, entries).collect()))
    assert fixed == {"teh": "the", "cars": "car", "zzzz": "zzzz", "the": "the"}
    forms = spark.createDataFrame([("cities",), ("walking",), ("glass",), ("women",), ("was",)], "word string")
    assert dict(map(tuple, lexical.lemmatise(forms).collect())) == {
        "cities": "city", "walking": "walk", "glass": "glass", "women": "woman"}


def test_period_sentences(spark):
    assert one(spark, "a b . c . d", T.period_sentences(F.col("x"))) == ["a b .", "c .", "d"]
    assert one(spark, "a . . b", T.period_sentences(F.col("x"))) == ["a .", ".", "b"]


def test_top_words_end_inside_a_frequency(spark):
    counts = spark.createDataFrame([(f"w{i:02}", 9 - i // 5) for i in range(40)], "word string, cnt long")
    for limit in (0, 1, 7, 10, 39, 40, 60):
        got = vocab.top_words(counts.repartition(5), limit).orderBy("word").collect()
        assert [r.word for r in got] == [f"w{i:02}" for i in range(min(limit, 40))]


def test_reserved_words_are_reported(spark):
    records = spark.createDataFrame([("[UNK] a a", "<s> b <s> </s>")], "article string, abstract string")
    assert {r.word for r in vocab.build_vocab(records).collect() if r.id >= 4} == {"a", "b"}
    assert [tuple(r) for r in vocab.reserved_words(records).collect()] == [("[UNK]", 1)]


def test_keys_too_long_for_a_number(spark):
    rows = spark.createDataFrame([("1" * 20, "t", "l"), ("no", "t", "l"), (" 12a", "t", "l")], "sno string, feedback string, label string")
    assert [r.sno for r in prepare.clean_feedback(rows).collect()] == [12]
    assert prepare.rejected_feedback(rows).count() == 2


def test_headers_in_any_case(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("SNO\tDate\tIssue\tLong Queue\tFees\n1\tx\tabc\t1\t0\n2\tx\tdef\t1\t1\n")
    rows = prepare.concept_rows(readers.concept_matrices(spark, [str(tmp_path / "c.tsv")])).collect()
    assert sorted((r.sno, r.issue, r.concept) for r in rows) == [
        (1, "abc", "long queue"), (2, "def", "fees"), (2, "def", "long queue")]


def test_joined_and_sent_vocabulary_agree(spark, small_vocab, monkeypatch):
    docs = spark.createDataFrame([(1, ["the", "zebra", "cat"]), (2, []), (3, ["cat", "cat"])], "k int, w array<string>")
    sent = {r.k: (r.w, r.i) for r in vocab.lookup_ids(docs, small_vocab, "k", "w", "i").collect()}
    monkeypatch.setattr(vocab, "SMALL_ROWS", 0)
    joined = {r.k: (r.w, r.i) for r in vocab.lookup_ids(docs, small_vocab, "k", "w", "i").collect()}
    assert sent[1] == joined[1] and sent[3] == joined[3] and sent[2] == ([], [])

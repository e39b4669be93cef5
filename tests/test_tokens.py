"""Lines, words, sub-words and packing."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom.functions.strings import lines_of
from linkloom.operators import stats, tokens as K


@pytest.mark.parametrize(
    "text, kept, blank",
    [
        ("a\n\nb\n", ["a", "b"], 1),
        ("ab\nc", ["ab"], 1),  # a last line without newline needs two characters
        ("ab\ncd", ["ab", "cd"], 0),
        ("\n\n", [], 2),
        ("", [], 0),
        ("a\r\nb\rc\n", ["a", "b", "c"], 0),
        (" \n", [" "], 0),
    ],
)
def test_lines(spark, text, kept, blank):
    df = spark.createDataFrame([("f", text)], "path string, text string")
    assert [r.line for r in K.nonblank_lines(df).orderBy("line_no").collect()] == kept
    row = stats.blank_line_stats(df).first()
    assert (row.n_lines - row.n_blank, row.n_blank) == (len(kept), blank)
    assert [r.line_no for r in df.select(F.inline(lines_of(F.col("text")))).collect()] == list(range(row.n_lines))


def test_words(spark):
    df = spark.createDataFrame([("f", "Don't stop, été 3.5!\n\nx\n")], "path string, text string")
    assert [r.tokens for r in K.tokenize(df).collect()] == ["Don ' t stop , été 3 . 5 !", "x"]
    with pytest.raises(ValueError):
        K.tokenize(df, "other")


def naive_merge(symbols, ranks):
    """Best pair first, all its places at once, by plain search."""
    while True:
        pairs = [p for p in zip(symbols, symbols[1:]) if p in ranks]
        if not pairs:
            return symbols
        best, out, i = min(pairs, key=ranks.get), [], 0
        while i < len(symbols):
            if tuple(symbols[i : i + 2]) == best:
                out.append(symbols[i] + symbols[i + 1])
                i += 2
            else:
                out.append(symbols[i])
                i += 1
        symbols = out


def trained_merges(rng, alphabet, n):
    known, merges = list(alphabet), []
    while len(merges) < n:
        pair = (rng.choice(known), rng.choice(known))
        if pair not in merges and len("".join(pair)) < 8:
            merges.append(pair)
            known.append("".join(pair))
    return merges


def test_merging_equals_plain_search():
    rng = random.Random(11)
    for _ in range(300):
        ranks = {p: i for i, p in enumerate(trained_merges(rng, "abc", 25))}
        symbols = [rng.choice("abc") for _ in range(rng.randint(1, 60))]
        assert K.merge_symbols(symbols, ranks) == naive_merge(symbols, ranks)


def test_long_words_take_no_quadratic_time():
    import time

    ranks = {("a", "a"): 0, ("aa", "aa"): 1, ("b", "a"): 2}
    start = time.time()
    assert len(K.merge_symbols(list("a" * 400_000), ranks)) == 100_000
    assert time.time() - start < 20


def test_byte_alphabet():
    alphabet = K.byte_alphabet()
    assert len(set(alphabet)) == 256
    assert (alphabet[ord("A")], alphabet[32], alphabet[10], alphabet[0xFF]) == ("A", "Ġ", "Ċ", "ÿ")


TEXTS = [
    "the thin man can't be there", "It's  double   spaces\n\n and\ttabs ", "été naïve 12ab34 ''quoted'' don't",
    "", " ", "we'll they've I'd I'm you're", "日本語 text ﬁn x　y", "trailing spaces   ",
]


def test_encoding_equals_a_public_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    alphabet = K.byte_alphabet()
    merges = trained_merges(random.Random(2), [alphabet[ord(c)] for c in "thein a"], 40)
    symbols = [*alphabet, *dict.fromkeys(a + b for a, b in merges)]
    ids = {s: i for i, s in enumerate(symbols)}
    judge = tokenizers.Tokenizer(tokenizers.models.BPE(vocab=ids, merges=merges))
    judge.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    vocab = spark.createDataFrame([(s, i) for s, i in ids.items()], "token string, id int")
    table = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(merges)], "rank int, left string, right string")
    texts = TEXTS + [" ".join(TEXTS)] * 5
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, text string").repartition(3)
    rows = {r.i: r for r in K.tokenize(docs, "gpt2", vocab=vocab, merges=table, eot=9999).collect()}
    for i, text in enumerate(texts):
        assert list(rows[i].ids) == [*judge.encode(text).ids, 9999], text
        assert rows[i].n_tokens == len(rows[i].ids)
    assert rows[len(texts)].ids is None


def test_vocabulary_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(K, "VOCAB_BYTES", 200)
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "token string, id int")
    with pytest.raises(ValueError):
        K.encode_subwords(vocab.withColumn("text", F.lit("x")), vocab, spark.createDataFrame([(0, "a", "b")], "rank int, left string, right string"))


def test_unknown_symbols_are_counted(spark):
    vocab = spark.createDataFrame([("a", 0)], "token string, id int")
    merges = spark.createDataFrame([], "rank int, left string, right string")
    docs = spark.createDataFrame([("abba",), ("aa",), ("",), (None,)], "text string")
    rows = {r.text: (r.ids, r.n_unknown) for r in K.encode_subwords(docs, vocab, merges).collect()}
    assert rows == {"abba": ([0, 0], 2), "aa": ([0, 0], 0), "": ([], 0), None: (None, None)}


def test_words_keep_their_marks(spark):
    import unicodedata

    text = unicodedata.normalize("NFKD", "été à Rio, n°5　中")
    words = spark.createDataFrame([(text,)], "t string").select(K.word_tokens(F.col("t"))).first()[0]
    assert [unicodedata.normalize("NFC", w) for w in words] == ["été", "à", "Rio", ",", "n", "°", "5", "中"]


def test_length_filter_counts_the_marker(spark):
    df = spark.createDataFrame([(n, [1] * n) for n in (18, 19, 20)], "n int, ids array<int>")
    kept = K.min_tokens(K.with_lengths(K.append_eot(df, 0)))
    assert sorted(r.n for r in kept.collect()) == [19, 20]


def pack_model(lengths, limit):
    shards, filled, number = [], 0, 0
    for n in lengths:
        filled += n
        shards.append(number)
        if filled > limit:
            filled, number = 0, number + 1
    return shards


def test_packing(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for batch in range(40):
        lengths = [rng.choice([0, 1, 5, 20, 100]) for _ in range(rng.randint(1, 60))]
        for pos, shard in enumerate(pack_model(lengths, 50)):
            want[batch, pos] = shard
        rows += [(batch, pos, n) for pos, n in enumerate(lengths)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "batch_id bigint, pos bigint, n_tokens bigint")
    assert {(r.batch_id, r.pos): r.shard_id for r in K.pack(df, 50).collect()} == want


def test_exact_limit_stays_open(spark):
    df = spark.createDataFrame([(0, 0, 30), (0, 1, 20), (0, 2, 1), (0, 3, 5)], "batch_id bigint, pos bigint, n_tokens bigint")
    assert [r.shard_id for r in K.pack(df, 50).orderBy("pos").collect()] == [0, 0, 0, 1]


def test_shards_keep_every_token(spark):
    rng = random.Random(4)
    docs = [(f"d{i:03}", [i] * rng.randint(1, 40)) for i in range(300)]
    encoded = K.with_lengths(spark.createDataFrame(docs, "path string, ids array<int>"))
    packed = K.pack_tokens(encoded, combine=200, min_length=20, batch_size=64)
    rows = K.shard_rows(encoded, packed)
    by_shard = {}
    for r in sorted(rows.collect(), key=lambda r: r.pos):
        by_shard.setdefault((r.batch_id, r.shard_id), []).extend(r.ids)
    kept = [d for d in docs if len(d[1]) >= 20]
    assert sum(map(len, by_shard.values())) == sum(len(d[1]) for d in kept)
    order = {}
    for r in packed.collect():
        order.setdefault((r.batch_id, r.shard_id), []).append((r.pos, r.path))
    content = dict(docs)
    for shard, ids in by_shard.items():
        paths = [p for _, p in sorted(order[shard])]
        assert ids == [x for p in paths for x in content[p]]
        total = len(ids)
        assert total - len(content[paths[-1]]) <= 200
    report = stats.token_report(encoded).first()
    assert (report.n_omitted, report.n_total) == (len(docs) - len(kept), len(docs))

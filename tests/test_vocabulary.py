"""Learning, encoding and decoding."""

import heapq
import json
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from textloom.config import SPECIAL_TOKENS, VocabularyConfig
from textloom.functions import sequences as seq
from textloom.operators import encode, pair_index, word_stats
from textloom.operators.learn import PairRanking, Round, learn_bpe
from textloom.operators.model import BpeModel
from textloom.plans import tokenizer


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id bigint, text string")


def learn(spark, values, vocab_size, min_frequency=0, **settings):
    counted = word_stats.word_counts(texts(spark, values))
    return learn_bpe(counted, VocabularyConfig(vocab_size, min_frequency, **settings))


def one_at_a_time(values, vocab_size, min_frequency=0):
    """Plain learning, one merge after the other, by full recounts."""
    import regex
    words = {}
    for value in values:
        for word in regex.findall(r"\w+|[^\w\s]+", value):
            words[word] = words.get(word, 0) + 1
    tokens = [*SPECIAL_TOKENS, *sorted({c for w in words for c in w})]
    ids = {t: i for i, t in enumerate(tokens)}
    states = [([ids[c] for c in w], n) for w, n in words.items()]
    merges = []
    while len(tokens) < vocab_size:
        counts = {}
        for state, n in states:
            for pair in zip(state, state[1:]):
                counts[pair] = counts.get(pair, 0) + n
        if not counts:
            break
        (a, b), n = min(counts.items(), key=lambda item: (-item[1], item[0]))
        if n < max(1, min_frequency):
            break
        text = tokens[a] + tokens[b]
        new = ids.setdefault(text, len(tokens))
        if new == len(tokens):
            tokens.append(text)
        merges.append((a, b, new))
        for state, _ in states:
            i = 0
            while i < len(state) - 1:
                if (state[i], state[i + 1]) == (a, b):
                    state[i:i + 2] = [new]
                i += 1
    return BpeModel(tuple(tokens), tuple(merges))


def random_corpus(seed, letters, n_words=60):
    rng = random.Random(seed)
    words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(n_words)]
    return [" ".join(rng.choices(words, k=30)) for _ in range(10)]


def test_word_pattern(spark):
    row = texts(spark, ["a_b c-d's ½ ²3 …!?"])
    got = [r.word for r in word_stats.pre_tokenize(row).orderBy("word_idx").collect()]
    assert got == ["a_b", "c", "-", "d", "'", "s", "½", "²", "3", "…!?"]


def test_symbols_round_trip_beyond_the_surrogates():
    for i in (0, 1, 0xD7FE, 0xD7FF, 0xD800, 70_000, 1_000_000):
        assert word_stats.token_id(word_stats.symbol(i)) == i
    ordered = [word_stats.symbol(i) for i in (0, 5, 0xD7FE, 0xD7FF, 70_000)]
    assert ordered == sorted(ordered)
    with pytest.raises(ValueError):
        word_stats.symbol(2_000_000)


def test_adjacent_pairs_overlap_and_know_code_points(spark):
    row = texts(spark, ["aaa😀é"]).select(word_stats.adjacent_pairs(F.col("text")).alias("p")).first()
    assert row.p == ["aa", "aa", "a😀", "😀é"]


def test_small_vocabulary(spark):
    model = learn(spark, ["aa ab ab"], 12)
    named = [(model.tokens[a], model.tokens[b]) for a, b, _ in model.merges]
    assert named == [("a", "b"), ("a", "a")]
    rarer = learn(spark, ["aa ab ab"], 12, min_frequency=2)
    assert [(rarer.tokens[a], rarer.tokens[b]) for a, b, _ in rarer.merges] == [("a", "b")]


def test_alphabet_is_never_cut(spark):
    model = learn(spark, ["abcdef"], 6)
    assert model.tokens == (*SPECIAL_TOKENS, *"abcdef") and not model.merges


def test_no_words(spark):
    assert learn(spark, ["", "  "], 20).tokens == SPECIAL_TOKENS


@pytest.mark.parametrize("seed, letters, limit", [
    (1, "ab", 1024), (2, "abc", 5), (3, "aaab", 3), (4, "abcdefgh", 7), (5, "xyé😀", 1)])
def test_rounds_equal_one_merge_at_a_time(spark, seed, letters, limit):
    corpus = random_corpus(seed, letters)
    expected = one_at_a_time(corpus, 45)
    got = learn(spark, corpus, 45, ranked_pairs=limit, merges_per_index=9)
    assert got == expected


def test_a_merge_into_an_existing_token_stands_alone():
    """No corpus is known that leads there, so the round is built by hand."""
    tokens = [*SPECIAL_TOKENS, "a", "b", "c", "d", "ab", "bc", "abc"]
    ids = {t: i for i, t in enumerate(tokens)}

    def pair(left, right):
        return word_stats.symbol(ids[left]) + word_stats.symbol(ids[right])

    ranking = PairRanking(10)
    ranking.refill([(pair("c", "d"), 5), (pair("a", "bc"), 4), (pair("d", "d"), 3)])
    first = Round(ranking, tokens, ids, 10, 1)
    assert first.new_tokens == ["cd"] and not first.reuses_token
    ranking.refill([(pair("a", "bc"), 4), (pair("d", "d"), 3)])
    second = Round(ranking, tokens, ids, 10, 1)
    assert second.merges == [(pair("a", "bc"), ids["abc"])]
    assert second.reuses_token and not second.new_tokens


def test_a_round_takes_hundreds_of_pairs_that_do_not_touch():
    tokens = [*SPECIAL_TOKENS, *(chr(0x4E00 + k) for k in range(400))]
    ids = {t: k for k, t in enumerate(tokens)}
    first = len(SPECIAL_TOKENS)
    pairs = [word_stats.symbol(first + 2 * k) + word_stats.symbol(first + 2 * k + 1) for k in range(200)]
    ranking = PairRanking(1_000)
    ranking.refill([(pair, 1_000 - k) for k, pair in enumerate(pairs)])
    assert Round(ranking, tokens, ids, 1_000, 1).pairs == pairs


def test_self_pairs(spark):
    corpus = ["aaaa " * 10 + "aaa " * 7 + "aaaaaaa " * 3 + "ba " * 4]
    assert learn(spark, corpus, 20) == one_at_a_time(corpus, 20)


def test_model_tables_round_trip(spark, tmp_path):
    model = learn(spark, random_corpus(6, "abcd"), 30)
    model.save(spark, str(tmp_path / "m"))
    assert BpeModel.load(spark, str(tmp_path / "m")) == model
    assert model.first(0).tokens == model.tokens[:model.vocab_size - len(model.merges)]
    special = model.vocab_table(spark).filter("special").orderBy("id").collect()
    assert [r.token for r in special] == list(SPECIAL_TOKENS)


def test_a_saved_tokenizer_is_reused(spark, tmp_path):
    path = str(tmp_path / "t")
    first = tokenizer.learn_tokenizer(texts(spark, ["ab ab"]), path, VocabularyConfig(10))
    assert tokenizer.learn_tokenizer(texts(spark, ["xyz"]), path, VocabularyConfig(10)) == first


HELLO = BpeModel((*SPECIAL_TOKENS, *"dehlorw"), ())


def encoded(spark, values, model):
    rows = texts(spark, values).select("id", encode.encode(F.col("text"), model).alias("ids")).orderBy("id")
    return [r.ids for r in rows.collect()]


def test_special_literals_and_unknown_characters(spark):
    ids = {c: HELLO.ids[c] for c in "dehlorw"}
    got = encoded(spark, ["[SOS]hello zzq [EOS] world[EOS]"], HELLO)[0]
    assert got == [2, *[ids[c] for c in "hello"], 0, 0, 0, 3, *[ids[c] for c in "world"], 3]


def test_markers_inside_punctuation(spark):
    assert encoded(spark, ["..[EOS]]", "[[PAD]", "[EOS", "", "   "], HELLO) == [
        [0, 0, 3, 0], [0, 1], [0, 0, 0, 0], [], []]


def test_tokenize_pads_and_cuts(spark):
    rows = texts(spark, ["d" * n for n in (3, 6, 7)] + [" "]).select(
        "id", encode.tokenize(F.col("text"), HELLO, 8).alias("ids")).orderBy("id").collect()
    d = HELLO.ids["d"]
    assert [r.ids for r in rows] == [[2, d, d, d, 3, 1, 1, 1], [2, *[d] * 6, 3], [2, *[d] * 7], [2, 3, 1, 1, 1, 1, 1, 1]]


def test_decode(spark):
    ids = [2, HELLO.ids["h"], HELLO.ids["e"], 0, 3, 1]
    row = spark.range(1).select(F.lit(ids).alias("ids")).select(
        encode.decode(F.col("ids"), HELLO).alias("plain"), encode.decode(F.col("ids"), HELLO, False).alias("all")).first()
    assert row.plain == "h e"
    assert row.all == "[SOS] h e [UNK] [EOS] [PAD]"


def test_encoder_equals_sequential_merges():
    """The lowest-rank merge first is the same as one merge after the other over the word."""
    corpus = random_corpus(7, "abc", 200)
    model = one_at_a_time(corpus, 60)
    encoder = encode.WordEncoder(model.tokens, model.merges)
    rng = random.Random(0)
    for _ in range(500):
        word = "".join(rng.choices("abc", k=rng.randint(1, 30)))
        state = [model.ids[c] for c in word]
        for a, b, new in model.merges:
            i = 0
            while i < len(state) - 1:
                if (state[i], state[i + 1]) == (a, b):
                    state[i:i + 2] = [new]
                i += 1
        assert encoder(word) == state


def test_a_very_long_word(spark):
    model = one_at_a_time(random_corpus(8, "ab"), 40)
    word = "".join(random.Random(1).choices("ab", k=200_000))
    ids = encoded(spark, [word, "ab"], model)[0]
    assert "".join(model.tokens[i] for i in ids) == word


def test_batches_of_any_size_give_the_same_ids(spark):
    corpus = random_corpus(9, "abcde")
    model = one_at_a_time(corpus, 40)
    once = encoded(spark, corpus, model)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert encoded(spark, corpus, model) == once
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("seed, letters", [(11, "abcd"), (12, "aab"), (13, "eé😀.,")])
def test_library_gives_the_same_merges_and_ids(spark, seed, letters):
    tokenizers = pytest.importorskip("tokenizers")
    corpus = random_corpus(seed, letters)
    library = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="[UNK]"))
    library.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    library.train_from_iterator(corpus, tokenizers.trainers.BpeTrainer(
        vocab_size=50, min_frequency=0, special_tokens=list(SPECIAL_TOKENS), show_progress=False))
    model = learn(spark, corpus, 50)
    merges = json.loads(library.to_str())["model"]["merges"]
    assert [[model.tokens[a], model.tokens[b]] for a, b, _ in model.merges] == [list(m) for m in merges]

    library.enable_truncation(32)
    library.enable_padding(length=32, pad_id=1, pad_token="[PAD]")
    values = corpus + ["[EOS]a[PAD]b..[SOS]", "unknown ÿ", " "]
    rows = texts(spark, values).select("id", encode.tokenize(F.col("text"), model, 32).alias("ids"))
    assert [r.ids for r in rows.orderBy("id").collect()] == [library.encode(f"[SOS]{v}[EOS]").ids for v in values]


@pytest.mark.parametrize("n", [127, 128, 129, 0])
def test_pad_truncate(spark, n):
    row = spark.range(1).select(seq.pad_truncate(F.expr(f"slice(array_repeat(7, 200), 1, {n})"), 128).alias("ids")).first()
    assert row.ids == ([7] * n + [1] * 128)[:128]


def finished(spark, prompt, generated, length):
    rows = spark.createDataFrame([(prompt, generated)], "p array<int>, g array<int>")
    return rows.select(seq.finish_sequence(F.col("p"), F.col("g"), length).alias("ids")).first().ids


def test_finish_sequence(spark):
    assert finished(spark, [2, 5], [7, 8, 3, 9], 8) == [2, 5, 7, 8, 1, 1, 1, 1]
    assert finished(spark, [2, 3], [7] * 10, 6) == [2, 3, 7, 7, 7, 1]
    assert finished(spark, [2, 5, 6], [], 5) == [2, 5, 6, 1, 1]
    assert finished(spark, [4, 5, 6], [7], 2) == [4, 5, 6]
    assert finished(spark, [2], [3, 7], 4) == [2, 1, 1, 1]


def test_shifted_pairs(spark):
    row = spark.createDataFrame([([2, 5, 6, 1],)], "ids array<int>").select(
        seq.inputs(F.col("ids")).alias("i"), seq.targets(F.col("ids")).alias("t"),
        seq.valid_mask(F.col("ids")).alias("m"), seq.valid_length(F.col("ids")).alias("n")).first()
    assert (row.i, row.t, row.m, row.n) == ([2, 5, 6], [5, 6, 1], [True, True, True, False], 3)


@pytest.mark.parametrize("words_per_file, merges_per_index", [(100_000, 1_000), (40, 1_000), (40, 11)])
def test_rounds_read_the_postings_of_their_pairs(spark, monkeypatch, words_per_file, merges_per_index):
    """Merges equal those of plain learning with one file and with many; few postings are read."""
    monkeypatch.setattr(pair_index, "WORDS_PER_FILE", words_per_file)
    rng = random.Random(3)
    corpus = random_corpus(5, "abcdefgh", n_words=400) + [" ".join(
        "".join(rng.choices("stuvwxyz", k=6)) for _ in range(300))]
    counted = word_stats.word_counts(texts(spark, corpus))
    rounds = []
    model = learn_bpe(counted, VocabularyConfig(130, merges_per_index=merges_per_index), rounds.append)
    assert model.merges == one_at_a_time(corpus, 130).merges
    n_postings = sum(len({*zip(w, w[1:])}) for w in (r.word for r in counted.collect()))
    assert len(rounds) > 8 and sum(r.merges for r in rounds) == len(model.merges)
    assert sum(r.postings_read for r in rounds) < 0.1 * n_postings * len(rounds)


def test_waiting_merges_give_the_present_word():
    rng = random.Random(7)
    for _ in range(200):
        word, merges, state = "".join(rng.choices("abc", k=rng.randrange(1, 14))), [], None
        state = word
        for new in "ABCDEFGH":
            pairs = {x + y for x, y in zip(state, state[1:])} - {pair for pair, _ in merges}
            if not pairs:
                break
            merges.append((rng.choice(sorted(pairs)), new))
            state = state.replace(*merges[-1])
        ranks = {pair: k for k, (pair, _) in enumerate(merges)}
        assert pair_index.merged_word(word, ranks, dict(enumerate(merges))) == state


def fast_one_at_a_time(counts, size):
    """Plain learning with pair counts and positions kept up, one merge after the other."""
    tokens = [*SPECIAL_TOKENS, *sorted({c for w in counts for c in w})]
    ids = {t: i for i, t in enumerate(tokens)}
    states = [([ids[c] for c in w], n) for w, n in counts.items()]
    pairs, where = Counter(), defaultdict(set)
    for k, (state, n) in enumerate(states):
        for pair in zip(state, state[1:]):
            pairs[pair] += n
            where[pair].add(k)
    heap = [(-n, pair) for pair, n in pairs.items()]
    heapq.heapify(heap)
    merges = []
    while heap and len(merges) < size:
        n, best = heapq.heappop(heap)
        if pairs[best] != -n or not n:
            if pairs[best]:
                heapq.heappush(heap, (-pairs[best], best))
            continue
        text = tokens[best[0]] + tokens[best[1]]
        new = ids.setdefault(text, len(tokens))
        if new == len(tokens):
            tokens.append(text)
        merges.append((*best, new))
        touched = set()
        for k in where.pop(best):
            state, count = states[k]
            for pair in zip(state, state[1:]):
                pairs[pair] -= count
            i = 0
            while i < len(state) - 1:
                if (state[i], state[i + 1]) == best:
                    state[i:i + 2] = [new]
                i += 1
            for pair in zip(state, state[1:]):
                pairs[pair] += count
                where[pair].add(k)
                touched.add(pair)
        for pair in touched:
            if pairs[pair]:
                heapq.heappush(heap, (-pairs[pair], pair))
    return merges


def test_thousands_of_merges(spark):
    """5,000 merges over the words of a table equal those of plain learning."""
    counted = word_stats.word_counts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    counts = {r.word: r.cnt for r in counted.collect()}
    expected = fast_one_at_a_time(counts, 5_000)
    assert len(expected) == 5_000
    n_chars = len({c for w in counts for c in w})
    rounds = []
    model = learn_bpe(counted, VocabularyConfig(len(SPECIAL_TOKENS) + n_chars + 5_000, ranked_pairs=4_096), rounds.append)
    assert list(model.merges) == expected
    n_postings = sum(len({*zip(w, w[1:])}) for w in counts)
    assert sum(r.postings_read for r in rounds) < 0.05 * n_postings * len(rounds)

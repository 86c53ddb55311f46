"""Best-two-fit packing, token alignment and spelling tiles against brute-force versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from textloom.llm import best_two_fit, queries, spelling_tiles, token_alignment
from textloom.llm.word_encoder import WordEncoder, vocabulary_bytes

SF_DIR = "/root/testdata/sf0.001"
BYTES, PIECES = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
ODD = ["", None, " ", "a", "  b", "x\n\ny z\n\n\nw", "it's I'll", "<s> </s> <unk>", "<|endoftext|> x", "a▁b", "日本語 テキスト 😀😀", "x" * 300 + " yé",
       "\n", "a \n b", "\x00 a", "▁", " 　a b", "ñ ﬁ ½", "é é", "a\x1fb c", "ŉ ǆ ɏ ʰ", "1²3 12ab", "😀" * 2000, "q" * 5000]


def odd_texts(n, seed=5):
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choice("ab'é1. \n\t!▁日😀") for _ in range(rnd.randrange(30))) for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES)


# Encoder -----------------------------------------------------------------------------

@pytest.mark.parametrize("names_are_text", [False, True])
def test_words_give_the_ids_of_whole_texts(tokenizer, names_are_text):
    texts = odd_texts(3000)
    encoder = WordEncoder(BYTES, kept_bytes=50_000, names_are_text=names_are_text)
    for at in range(0, len(texts), 250):
        part = texts[at:at + 250]
        ids, sizes = encoder.encode(pa.array(part, pa.string()))
        whole = [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in part], add_special_tokens=False)]
        assert [list(x) for x in np.split(ids, np.cumsum(sizes)[:-1])] == whole
    assert len(encoder.number) * 240 <= 50_000 + 240 * 3000


def test_runs_met_again_stay_when_there_are_too_many(monkeypatch):
    """Rare runs fill what is kept many times over; frequent ones are encoded once all the same."""
    encoder = WordEncoder(BYTES, kept_bytes=240 * 400)
    fresh, encoded = encoder._fresh, []
    monkeypatch.setattr(encoder, "_fresh", lambda runs: encoded.extend(runs) or fresh(runs))
    frequent = [f"qu{a}{b}zor" for a in "abcde" for b in "fghij"]
    letters = "abcdefghijklmnopqrstuvwxyz"
    for k in range(60):
        rare = [f"{letters[k % 26]}{letters[k // 26]}{letters[j % 26]}{letters[j // 26]}xyx" for j in range(100)]
        text = " ".join(["start", *frequent, *rare])
        ids, sizes = encoder.encode(pa.array([text]))
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids and sizes.tolist() == [len(ids)]
        assert len(encoder.number) <= 400 + len(frequent) + 102
    assert len(encoded) > 6000 and all(encoded.count(f" {word}") == 1 for word in frequent)


def test_runs_and_words_of_several(monkeypatch):
    """A word of one run is not cut, others are, into the same runs as the tokenizer's words."""
    texts = ["one", "a one, two", "x1y2 \n z", "ab12!? \n\n c", "don't 12,5 é日", "", None, "n\nm o\n"]
    encoder = WordEncoder(BYTES)
    seen, fresh = [], encoder._fresh
    monkeypatch.setattr(encoder, "_fresh", lambda runs: seen.extend(runs) or fresh(runs))
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    whole = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == whole
    assert {" one", ",", " two", "x", "1", "y", "2", " 12", "ab"} <= {*seen, *encoder.number}


# Packing -----------------------------------------------------------------------------

def plain_fillings(lengths, capacity):
    """One sequence after the other, over a plain list of lengths."""
    free, out = sorted(lengths), []
    while free:
        filled = [free.pop()]
        gap = capacity - filled[0]
        while fitting := [x for x in free if x <= gap]:
            free.remove(max(fitting))
            filled.append(max(fitting))
            gap -= filled[-1]
        while gap and len(filled) > 1:
            smallest, best = min(filled), None
            for x, y in itertools.combinations(free[::-1], 2):
                if smallest < x + y <= gap + smallest and (best is None or (x + y, x) > (sum(best), best[0])):
                    best = (x, y)
            if best is None:
                break
            filled.remove(smallest)
            gap += smallest - sum(best)
            for x in best:
                free.remove(x)
                filled.append(x)
            free = sorted([*free, smallest])
        out.append(sorted(filled))
    return sorted(out)


def test_counted_plan_is_the_plain_one():
    rnd = random.Random(3)
    for _ in range(150):
        capacity = rnd.choice([10, 37, 100])
        lengths = [min(capacity, max(1, int(rnd.choice([rnd.random() * capacity, rnd.expovariate(6 / capacity)]))))
                   for _ in range(rnd.randrange(50))]
        plan = best_two_fit.plan_fillings(np.bincount(lengths, minlength=capacity + 1), capacity)
        made = [sorted(length for length, n in zip(f.lengths, f.counts) for _ in range(n)) for f in plan for _ in range(f.times)]
        assert sorted(made) == plain_fillings(lengths, capacity)


def test_plan_does_not_grow_with_the_documents():
    lengths = np.minimum(1024, np.random.default_rng(1).lognormal(6, 1, 100_000).astype(int) + 1)
    counts = np.bincount(lengths, minlength=1025)
    short, long = (best_two_fit.plan_fillings(counts * k, 1024) for k in (1, 1_000_000))
    assert len(long) <= 1.2 * len(short) < 3000
    assert sum(f.times for f in long) <= 1.002 * -(-int(lengths.sum()) * 1_000_000 // 1024)


def check_places(rows, texts, tokenizer, capacity, end_id):
    """Pieces of ``(doc_id, text)`` rows against the tokenizer's ids; no gaps, nothing over the capacity."""
    wanted = Counter()
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        first = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            wanted[(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == wanted
    inside = defaultdict(list)
    for r in rows:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in inside.values():
        ends = list(itertools.accumulate(length for _, length in sorted(own)))
        assert [offset for offset, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= capacity
    return inside


def test_packed_documents(spark, tokenizer):
    docs = queries.table(spark, SF_DIR, "documents")
    rows = queries.QUERIES["op11_best_two_fit"](spark, SF_DIR).collect()
    inside = check_places(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, 1024, 2)
    lengths = [r["length"] for r in rows]
    assert sorted(sorted(n for _, n in own) for own in inside.values()) == sorted(map(sorted, plain_fillings(lengths, 1024)))


def test_packing_of_odd_rows(spark, tokenizer):
    rows = [(None if k % 5 == 0 else k % 7, text, k, k) for k, text in enumerate(odd_texts(200))] * 2
    docs = spark.createDataFrame(rows, "doc_id int, text string, part int, sequence_id long").repartition(5)
    placed = best_two_fit.places(docs, BYTES, capacity=40)
    assert placed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check_places(placed.collect(), [r[:2] for r in rows], tokenizer, 40, 2)
    found = best_two_fit.pieces(docs, BYTES, capacity=40)
    by_id = defaultdict(list)
    for r in best_two_fit.sequences(found, 40).collect():
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["n_ids"] == sum(d["length"] for d in r["docs"]) <= 40
        for d in r["docs"]:
            by_id[(d["doc_id"], d["piece"])].append(ids[d["offset"]:d["offset"] + d["length"]].tobytes())
    kept = defaultdict(list)
    for r in best_two_fit.pack(docs, BYTES, capacity=40).collect():
        kept[(r["doc_id"], r["piece"])].append(bytes(r["ids"]))
    assert {k: sorted(v) for k, v in by_id.items()} == {k: sorted(v) for k, v in kept.items()}
    assert best_two_fit.places(docs.limit(0), BYTES).count() == 0
    assert best_two_fit.sequences(best_two_fit.pieces(docs.limit(0), BYTES)).count() == 0


# Alignment ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def plain_alignment():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(BYTES)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_bytes, b_bytes = vocabulary_bytes(BYTES), token_alignment.piece_bytes(PIECES)

    def groups(text):
        if not text:
            return []
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        whole = (" " + text).encode()
        if b"".join(a_bytes[k] for k in a) != whole or b"".join(b_bytes[k] for k in b) != whole:
            return []
        a_ends, b_ends = (list(itertools.accumulate(len(v[k]) for k in ids)) for v, ids in ((a_bytes, a), (b_bytes, b)))
        out, start = [], 0
        for end in sorted(set(a_ends) & set(b_ends)):
            out.append(tuple([k for k, e in zip(ids, ends) if start < e <= end] for ids, ends in ((a, a_ends), (b, b_ends))))
            start = end
        return out

    return groups


def plain_result(texts, plain_alignment):
    """The result's columns for each text, counts over all of ``texts``."""
    all_groups = [plain_alignment(t) for t in texts]
    links = [Counter(pair for a, b in groups for pair in itertools.product(a, b)) for groups in all_groups]
    count = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for groups, own in zip(all_groups, links):
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
                    sum(n for pair, n in own.items() if count[pair] == most[pair[0]]),
                    sum(n * count[pair] for pair, n in own.items()),
                    hashlib.sha256(written.encode()).hexdigest() if groups else ""))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_pointers_reach_the_last_token_of_a_group():
    rnd = random.Random(8)
    for _ in range(200):
        n = rnd.randrange(1, 60)
        ends = [np.array(sorted({n, *rnd.sample(range(1, n + 1), rnd.randrange(1, n + 1))})) for _ in range(2)]
        cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        last = token_alignment.last_tokens(*ends)
        assert [ends[0][k] for k in last] == [min(c for c in cuts if c >= e) for e in np.concatenate(ends)]


def test_aligned_documents(spark, plain_alignment):
    docs = queries.table(spark, SF_DIR, "documents").collect()
    wanted = dict(zip([r["doc_id"] for r in docs], plain_result([r["text"] for r in docs], plain_alignment)))
    got = queries.QUERIES["op12_token_alignment"](spark, SF_DIR).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == wanted and len(got) == len(docs)


def test_alignment_of_odd_rows_in_small_blocks(spark, plain_alignment):
    texts = odd_texts(300)
    rows = [(None if k % 4 == 0 else k % 9, text, k, k) for k, text in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id int, text string, block long, part string").repartition(3)
    wanted = Counter(zip([r[0] for r in rows], plain_result([r[1] for r in rows], plain_alignment)))
    got = token_alignment.align_documents(docs, BYTES, PIECES, block_words=50)
    assert Counter((r["doc_id"], tuple(r[c] for c in COLUMNS)) for r in got.collect()) == wanted
    assert token_alignment.align_documents(docs.limit(0), BYTES, PIECES).count() == 0


def test_written_groups(spark, plain_alignment):
    texts = odd_texts(20)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(g["a"], g["b"]) for g in r["groups"]] for r in token_alignment.aligned_groups(docs, BYTES, PIECES).collect()}
    assert got == {k: plain_alignment(t) for k, t in enumerate(texts)}


# Spelling ----------------------------------------------------------------------------

def plain_spelling(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            count[run[:at] + run[at + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    patterns = defaultdict(set)         # replaced letters share a pattern; a letter more or less shares a shorter word
    near = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            patterns[(w[:k], w[k + 1:])].add(w)
            shorter = w[:k] + w[k + 1:]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in patterns.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def spelled(df):
    rows = df.collect()
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_spelling_groups(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    wanted = plain_spelling([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(v[0] is not None for v in wanted.values()) > 1000
    assert spelled(queries.QUERIES["op13_spelling_tiles"](spark, "/root/testdata/sf0.01")) == wanted


@pytest.mark.parametrize("block_rows", [3, 1024])
def test_spelling_of_odd_rows_in_small_blocks(spark, block_rows):
    rnd = random.Random(4)
    stems = ["".join(rnd.choice("abÀÿ×") for _ in range(rnd.randrange(5, 8))) for _ in range(60)]
    rows = [(None if k % 6 == 0 else k % 11, " ".join(rnd.choices(stems, weights=range(1, 61), k=80)) + rnd.choice(["", "; Ab'cDEF 12"]), k, "x")
            for k in range(60)]
    rows += [(1, "z" * 4000 + " " + "z" * 4001, 1, "y")] * 3 + [(2, None, 1, "y"), (3, "", 1, None), (None, "ÀAAAA àaaaa", 2, "q")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n long, word string").repartition(4)
    assert spelled(spelling_tiles.spelling_groups(docs, block_rows=block_rows)) == plain_spelling([r[:2] for r in rows])
    assert spelling_tiles.spelling_groups(docs.limit(0)).count() == 0


def test_ends_of_chains(spark):
    forms = [(f"w{k:03d}", f"w{k + 1:03d}") for k in range(40)] + [("x", "y")]
    found = {r["word"]: r["root"] for r in spelling_tiles.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert found == {f"w{k:03d}": "w040" for k in range(40)} | {"x": "y"}

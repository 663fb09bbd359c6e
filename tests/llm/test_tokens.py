"""Token counts and packing against the tokenizer itself."""

import random
import unicodedata
import zlib
from array import array
from collections import defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from courtline.llm import packing
from courtline.llm.packing import best_fit, pack, packing_plan
from courtline.llm.token_counts import token_counts
from courtline.llm.words import id_cache, length_cache

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_words_encode_as_the_library_does():
    rng = random.Random(3)
    parts = [*"abAB.,!'éÉßŞİıΣσǅ 12\n\t\x1c\x85\xa0 ́̊中ﬁẛ"]
    parts += ["<|endoftext|>", "'s", "'LL", "Å", "K", "\U0001f600", "the", "Station,", "ÊTRE."]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        got = array("I", b"".join(b"".join(x) for x in id_cache(PATH).values_of(text)))
        assert list(got) == ids_of(text), repr(text)
        assert sum(map(sum, length_cache(PATH).values_of(text))) == len(got)


def test_letters_that_nfc_takes_apart():
    letters = [c for c in map(chr, range(0x80, 0x30000)) if c.isalpha() and not unicodedata.is_normalized("NFC", c)]
    assert len(letters) > 59
    for c in letters:
        for text in (f"{c},", f"{c}.", f"a{c}.", f"{c}{c}, {c}a."):
            got = array("I", b"".join(b"".join(x) for x in id_cache(PATH).values_of(text)))
            assert list(got) == ids_of(text), repr(text)


def test_special_strings_in_other_case_are_text():
    rng = random.Random(4)
    parts = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|StartOfText|>", "<|startoftext|>", "a", "B", ".", ",", " ", "<|"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 6)))
        got = array("I", b"".join(b"".join(x) for x in id_cache(PATH).values_of(text)))
        assert list(got) == ids_of(text), repr(text)
        assert sum(map(sum, length_cache(PATH).values_of(text))) == len(got)


def check_counts(docs):
    rows = token_counts(docs, PATH).select("text", "n_bytes", "n_tokens", "over_limit").collect()
    assert len(rows) == docs.count()
    for r in rows:
        n = len(ids_of(r.text))
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 2048, len((r.text or "").encode()))


def test_counts_match_the_library(small):
    check_counts(small.repartition(40))  # more partitions than one merge takes


def test_counts_of_odd_rows(odd, none):
    check_counts(odd.withColumn("n_tokens", F.lit("clash")))
    assert token_counts(none, PATH).count() == 0


def check_packing(docs, capacity=4096):
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.select("doc_id", "text").collect())
    wanted = []
    for null, doc_id, text in texts:
        ids = ids_of(text) + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            crc = zlib.crc32(array("I", part).tobytes())
            wanted.append((null, doc_id, piece, start, len(part), crc))
    rows = pack(docs, PATH, capacity=capacity).collect()
    got = [(r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got) == sorted(wanted)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), -(-sum(w[4] for w in wanted) // capacity)


def test_packing_fills_sequences(small):
    used, bound = check_packing(small.repartition(20))
    assert used <= 1.05 * bound + 1  # ten documents a task: the merges do most of the packing


def test_packing_goes_on_beyond_a_tasks_bins(small, odd, monkeypatch):
    monkeypatch.setattr(packing, "TASK_BINS", 1)
    used, bound = check_packing(small.repartition(20))
    assert used <= 1.05 * bound + 1
    check_packing(odd.repartition(3), capacity=64)


def test_merging_goes_on_after_a_round_that_saves_nothing(spark, monkeypatch):
    # 90 tokens each in the first four tasks, 30 in the last: nothing to save until they meet
    monkeypatch.setattr(packing, "FAN_IN", 2)
    texts = [" ".join(["a"] * (89 if k < 4 else 29)) for k in range(5)]
    docs = spark.sparkContext.parallelize([(k, t) for k, t in enumerate(texts)], 5).toDF("doc_id long, text string")
    used, _ = check_packing(docs, capacity=120)
    assert used == 4


def test_plan_packs_as_best_fit_does():
    rng = random.Random(5)
    for capacity in (7, 50, 300):
        for _ in range(60):
            sizes = [rng.randint(1, rng.choice([capacity - 1, 5])) for _ in range(rng.randint(1, 200))]
            counts = {s: sizes.count(s) for s in sizes}
            fills, ranks = defaultdict(int), defaultdict(list)
            for size, first, last, each, base in packing_plan(counts, capacity):
                ranks[size] += range(first, last + 1)
                for rank in range(first, last + 1):
                    fills[base + (rank - first) // each] += size
            assert {s: len(r) for s, r in ranks.items()} == counts
            assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
            wanted = best_fit([(n, i, [{"length": n}]) for i, n in enumerate(sizes)], capacity)
            assert sorted(fills.values()) == sorted(f for f, _ in wanted)


def test_packing_of_odd_rows(odd, none):
    check_packing(odd.withColumn("piece", F.lit("clash")), capacity=64)
    assert pack(none, PATH).count() == 0


def test_best_fit_takes_the_fullest_bin():
    member = lambda n: [{"length": n}]
    bins = best_fit([(n, i, member(n)) for i, n in enumerate([6, 5, 4, 3, 2])], 10)
    assert sorted(fill for fill, _ in bins) == [10, 10]

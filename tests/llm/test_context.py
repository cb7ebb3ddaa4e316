"""Context mixing runs over whole texts."""

import numpy as np
import pyarrow as pa

from tillstream.llm import lmscore, mixing


def test_order_of_words_counts(spark):
    docs = spark.createDataFrame(
        [(i, "red cat sat. old dog ran. " * 20) for i in range(1, 40)]
        + [(1000, "red cat sat. old dog ran."), (1001, "red dog sat. old cat ran.")],
        "doc_id long, text string",
    )
    got = {r.doc_id: r for r in lmscore.score(docs).collect()}
    assert got[1000].score > got[1001].score + 1
    assert got[1000].bits_per_byte < got[1001].bits_per_byte
    assert got[1000].base_score == got[1001].base_score


def test_every_occurrence_counts():
    keys, words, times = mixing.distinct(pa.array(["ab ab ab", "", None, "b"]))
    assert times.sum() == 9 + 1 + 1 + 2
    assert max(times) >= 2 and len(keys) == len(words) == len(times)


def test_the_word_before_is_a_context():
    one, two = (mixing.bytes_of(pa.array([t])) for t in ("black horses run", "white horses run"))
    same = mixing.bytes_of(pa.array(["a Black  horses run"]))
    assert one.keys[-1] == two.keys[-1]
    at = one.keys.tolist().index(one.keys[10])  # in the middle of "horses"
    assert one.words[at] != two.words[at] and one.words[-1] == two.words[-1]
    assert one.words[at] == same.words[at + 3]


def test_rare_bits_outlive_large_counts():
    counts = np.zeros((2, mixing._region_rows(0)), "<u4")
    counts[:, 0] = 3_000_000_000, 1
    part = pa.compress(counts, "zstd", asbytes=True)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0], pa.int32()), pa.array([part, part])], ["region", "counts"])
    (out,) = mixing._summed(iter([batch]))
    sums = np.frombuffer(out.column(1)[0].as_py(), "<f4").reshape(2, -1)
    assert sums[:, 0].tolist() == [6_000_000_000, 2]


def test_likely_bytes_take_few_decisions():
    pairs = np.zeros((256, 256))
    pairs[ord("q"), ord("u")] = 1000
    pairs[ord("t"), ord("h")], pairs[ord("t"), ord("o")] = 500, 400
    tree = mixing.trees(pairs)
    every = tree.sizes.reshape(256, 256)
    assert every[ord("q"), ord("u")] == 1 and every[ord("t"), ord("h")] <= 2 and every[ord("t"), ord("o")] <= 2
    assert np.allclose((0.5 ** every).sum(axis=1), 1)  # each byte has its leaf
    of, places, marks = tree.decisions(np.array([ord("q") << 8 | ord("u"), ord("t") << 8 | ord("h")], np.uint64))
    assert of.tolist() == [0] + [1] * int(every[ord("t"), ord("h")]) and len(places) == len(marks) == len(of)


def test_states_keep_small_counts_and_ratios():
    both = np.array([[0, 1, 7, 0, 3e9, 1], [0, 0, 5, 2000, 6e9, 3e9]], np.float32)
    state = mixing._states(both).astype(int)
    zeros, ones = mixing._STEPS[state >> 6], mixing._STEPS[state & 63]
    assert zeros[:4].tolist() == [0, 1, 7, 0] and ones[:3].tolist() == [0, 0, 5]
    assert abs(ones[3] / 2000 - 1) < 0.13 and abs(ones[4] / zeros[4] / 2 - 1) < 0.25
    assert zeros[5] == 1 and ones[5] > 1e5  # a rare way never counts as unseen

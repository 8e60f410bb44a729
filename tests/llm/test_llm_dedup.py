from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm_helpers import LETTERS, awkward, changed, documents, found, plain_words, prose, unspaced
from pyspark.sql import functions as F

from duelmetrics.llm import exact_dedup, near_dedup
from duelmetrics.llm.common import normal_bytes, shingle_hashes, word_hashes, word_spans


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups_equal_brute_force(spark, keep):
    rows = [(k, f"text {k % 7}" if k % 3 else "hot") for k in range(900)]
    rows += [(1000 + k, None if k % 2 else "") for k in range(10)]
    got = found(exact_dedup.exact_groups(documents(spark, rows).repartition(9), keep))
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    pick = max if keep == "largest" else min
    want = {i: (pick(g), len(g), i == pick(g)) for g in groups.values() for i in g}
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in got} == want
    assert len({r["text_sha256"] for r in got}) == len(groups)


@pytest.mark.parametrize("partitions", ["1", "3", "60"])
def test_a_hot_text_crosses_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k, "hot" if k % 10 else f"other {k}") for k in range(3000)]
        df = documents(spark, rows).repartition(5)
        got = {r["doc_id"]: r for r in found(exact_dedup.exact_groups(df))}
        kept = found(exact_dedup.drop_copies(df))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[1]["group_size"] == 2700 and got[1]["keep_id"] == 2999
    assert sum(r["kept"] for r in got.values()) == 301 == len(kept)


def test_texts_with_a_common_head_and_normalisation(spark):
    head = "same beginning of every text " * 20
    rows = [(k, head + str(k // 2)) for k in range(40)] + [(99, (head + "0").upper())]
    groups = found(exact_dedup.content_sort(documents(spark, rows), normalise=F.lower))
    assert {r["id"]: r["group_size"] for r in groups}[99] == 3
    assert next(r for r in groups if r["id"] == 99)["keep_id"] == 0
    with pytest.raises(ValueError, match="smallest or largest"):
        exact_dedup.content_sort(documents(spark, rows), keep="newest")


def test_exact_awkward_rows(spark):
    df = documents(spark, awkward(), clash=True)
    got = found(exact_dedup.exact_groups(df))
    assert len(got) == len(awkward())
    empty = [r for r in got if r["doc_id"] in (1, 2)]
    assert all((r["keep_id"], r["group_size"]) == (2, 3) for r in empty)
    twins = [r for r in got if r["group_size"] == 3 and r["keep_id"] == 7]
    assert len(twins) == 3 and sum(r["kept"] for r in twins) == 1
    left = exact_dedup.drop_copies(df)
    assert left.columns == df.columns and left.count() == len({r["text_sha256"] for r in got})
    texts = {(r["doc_id"], r["text"]) for r in found(left)}
    assert texts <= {(r[0], r[1]) for r in awkward()}
    assert found(exact_dedup.exact_groups(df.filter("false"))) == []
    assert found(exact_dedup.drop_copies(df.filter("false"))) == []


def brute_classes(rows, threshold=0.8):
    """Components of all links, by comparing every pair of texts."""
    sets, parent = {}, {}
    for doc_id, text in rows:
        sets[doc_id], parent[doc_id] = near_dedup.weighted_shingles(text), doc_id

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if len(sets[a][0]) and near_dedup.similarity(sets[a], sets[b]) >= threshold:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def chained():
    """Groups of near copies: stars, a chain whose ends differ, and a large group with outliers."""
    rows, n = [], 0
    for group in range(12):
        base = prose(100 + group, 120)
        for k in range(6):
            rows.append((n, changed(base, [(7 * k + 3 * j) % 120 for j in range(k)])))
            n += 1
    text = prose(900, 150)
    for k in range(25):
        rows.append((n, text.upper() if k % 2 else text + " ..."))
        text, n = changed(text, [k * 5, k * 5 + 1]), n + 1
    base = prose(901, 100)
    for k in range(120):
        rows.append((n, changed(base, [k % 100, (k * 37) % 100, (k * 61) % 100][: 1 + k % 3])))
        n += 1
    return rows + [(n + k, prose(2000 + k, 80)) for k in range(60)]


def test_near_classes_equal_brute_force(spark):
    rows = chained()
    got = found(near_dedup.near_classes(documents(spark, rows).repartition(4), block=16))
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)
    sizes = defaultdict(int)
    for r in got:
        sizes[r["class_id"]] += 1
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got)


def test_near_awkward_rows(spark):
    df = documents(spark, awkward(), clash=True)
    got = found(near_dedup.near_classes(df))
    assert len(got) == len(awkward())
    by_id = defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    assert by_id[10][0]["class_id"] == 6 and by_id[6][0]["class_size"] == 2
    assert all(by_id[k][0]["class_id"] == k for k in (1, 2, 3, 4, 5, 8, 9))
    assert sorted(r["class_size"] for r in by_id[7]) == [1, 3, 3]
    left = near_dedup.drop_near_copies(df)
    assert left.columns == df.columns
    assert left.filter("doc_id in (7)").count() == 2 and left.filter("doc_id is null").count() == 1
    assert found(near_dedup.near_classes(df.filter("false"))) == []
    assert found(near_dedup.drop_near_copies(df.filter("false"))) == []


def test_a_line_that_repeats_links_nothing(spark):
    line = "the very same line of words again and again "
    rows = [(k, line * 40 + prose(k, 150)) for k in range(30)]
    got = found(near_dedup.near_classes(documents(spark, rows)))
    assert {r["class_size"] for r in got} == {1}


def repeating(seed):
    """Two texts that differ in a word of a line they repeat: plain Jaccard 0.86, probability Jaccard 0.63."""
    line = prose(seed + 1, 8)
    head = prose(seed, 60)
    return [f"{head} {' '.join([x] * 30)}" for x in (line, changed(line, [3]))]


def test_plain_links_of_texts_with_a_repeated_line_are_found(spark):
    rows = [(2 * k + j, text) for k in range(120) for j, text in enumerate(repeating(7000 + 2 * k))]
    a, b = (near_dedup.weighted_shingles(t) for _, t in rows[:2])
    assert near_dedup.probability_jaccard(a, b) < 0.65 and near_dedup.similarity(a, b) > 0.8
    got = found(near_dedup.near_classes(documents(spark, rows).repartition(4)))
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(rows)


def test_blocks_of_a_bucket_keep_plain_links():
    bands, rows = near_dedup.BANDS, near_dedup.ROWS
    least = near_dedup.SIMILARITY - near_dedup.MARGIN * (0.16 / (bands * rows)) ** 0.5
    cross = near_dedup._cross(near_dedup.SIMILARITY, least, bands, rows, near_dedup.WORDS)
    for k in range(40):
        batch = pa.RecordBatch.from_pydict({"print": [b"a", b"b"], "text": repeating(7000 + 2 * k)})
        packed = pd.concat(
            x.to_pandas() for x in near_dedup._pack(bands, rows, near_dedup.WORDS)(iter([batch]))
        )
        block = packed.assign(label=packed["print"], role=[1, 0])
        links = [link for n in range(bands) for link in cross(block.assign(bucket=n)).values.tolist()]
        assert links == [[b"b", b"a"]]


def test_exact_copies_form_one_class_without_pairs(spark):
    rows = [(k, prose(5, 50) if k % 3 else prose(1000 + k, 50)) for k in range(600)]
    got = found(near_dedup.near_classes(documents(spark, rows)))
    assert {r["class_id"] for r in got if r["doc_id"] % 3} == {1}
    assert {r["texts"] for r in got} == {1}


def test_registers_estimate_probability_jaccard():
    draw = np.random.default_rng(1)
    keys = draw.integers(0, 2**63, 400).astype(np.uint64)
    a, b = np.sort(keys[:300]), np.sort(keys[60:])
    u, v = draw.integers(1, 9, 300).astype(float), draw.integers(1, 9, 340).astype(float)
    exact = near_dedup.probability_jaccard((a, u), (b, v))
    slow = sum(
        1 / sum(max(dict(zip(a, u)).get(j, 0) / x, dict(zip(b, v)).get(j, 0) / y) for j in set(a) | set(b))
        for i in set(a) & set(b)
        for x, y in [(dict(zip(a, u))[i], dict(zip(b, v))[i])]
    )
    assert exact == pytest.approx(slow)
    signs = near_dedup.prob_minhash([a, b, a[:1], a], [u, v, u[:1], u], 2000)
    assert abs((signs[0] == signs[1]).mean() - exact) < 0.05
    assert (signs[0] == signs[3]).all() and (signs[2] == a[0]).all()


#: Letters, blanks and marks of one to four bytes, with and without blanks between words.
MIXED = "aZ9 .'\n\t\x00é\u00a0«»ßГд،שλ́…—“’\u200b\ufeff語のカー々。、！Ａกิ่한😀𠀀"


@given(st.text(MIXED, max_size=60))
def test_words_equal_those_found_character_by_character(text):
    data = normal_bytes(text)
    _, starts, ends = word_spans(data)
    assert [data[a:b].decode() for a, b in zip(starts, ends)] == plain_words(text)


@pytest.mark.parametrize("script", LETTERS)
def test_near_copies_in_scripts_without_blanks(spark, script):
    rows, n = [], 0
    for group in range(10):
        base = unspaced(script, group, 150)
        for k in range(5):  # one letter more, others changed, other stops
            text = base[: 20 * k] + "".join(LETTERS[script][j] for j in range(k)) + base[20 * k :]
            rows += [(n, text), (n + 1, text.replace("。", "、"))]
            n += 2
    rows += [(n + k, unspaced(script, 500 + k, 90)) for k in range(30)]
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, plain_words(t)) for i, t in rows)}
    linked = {
        (a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    }
    got = {r["doc_id"]: r["class_id"] for r in found(near_dedup.near_classes(documents(spark, rows)))}
    assert got == brute_classes(rows)
    assert len(linked) > 100 and all(got[a] == got[b] for a, b in linked)
    assert all(got[n + k] == n + k for k in range(30))


def test_words_and_shingles():
    assert len(word_hashes(normal_bytes("Don't, stop! naïve 日本"))) == 6
    assert (word_hashes(b"abc abc")[0]) == word_hashes(b"xx abc")[1]
    assert len(shingle_hashes(word_hashes(b"a b c"))) == 1
    assert len(shingle_hashes(word_hashes(b"a b c d e f"))) == 2
    assert len(word_hashes(normal_bytes(None))) == 0
    assert len(set(word_hashes(" ".join(map(str, range(5000))).encode()).tolist())) == 5000

"""Quality rules: base counts against plain ones, measures and bands on texts of known kind."""

import math
import random
from collections import Counter

import pytest
from llm_helpers import awkward, documents, found, prose

from duelmetrics.llm.quality import (
    VOCABULARIES,
    Words,
    fertility,
    load_vocabulary,
    measure_texts,
    measured,
    quality,
    script,
)


def plain_words(text):
    words, now = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [now] if now else []
            now = ""
        else:
            now += c
    return words


def plain_counts(text):
    words = plain_words(text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    times = Counter(windows)
    inside = {k + d for k, w in enumerate(windows) if times[w] > 1 for d in range(8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if plain_words(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(inside)


def texts():
    r = random.Random(4)
    given = [t or "" for _, t, *_ in awkward()]
    given += [" ".join(r.choices("ab", k=n)) for n in (8, 9, 20, 60, 200)]
    given += ["line\nline\n\n\nline\r\nline   x", "a\x0bb\x0cc\u0085d", prose(3, 40) + "\n" + prose(3, 40)]
    return given


def test_base_counts_equal_plain_ones():
    given = texts()
    columns = measure_texts(given, [])[1:6]
    assert list(zip(*(map(int, c) for c in columns))) == [plain_counts(t) for t in given]
    for text in given:
        assert tuple(int(c[0]) for c in measure_texts([text], [])[1:6]) == plain_counts(text)


def test_windows_that_overlap_stay_within_their_text():
    once, twice = "a b c d e f g h", "a b c d e f g h x a b c d e f g h"
    assert Words([once, once, twice, "a " * 9, once, "", "b a"]).repeated().tolist() == [0, 0, 16, 9, 0, 0, 0]
    assert Words([]).repeated().tolist() == []


@pytest.mark.parametrize("name", VOCABULARIES)
def test_measures_of_a_vocabulary(name):
    with open(name, "rb") as file:
        encoder, partial = load_vocabulary(name, file.read())
    text, rare = "The first of them was there. " * 3, "\U00013080\U00013081" * 20  # no vocabulary has these
    total, length, share, entropy = fertility(Words([text, "", rare, "y" * 2_500]), encoder, partial)
    ids = [t for w in text.split() for t in encoder([w])[0]]
    n, times = len(ids), Counter(ids).values()
    assert total[0] == n and length[0] == pytest.approx(math.log2(sum(map(len, text.split())) / n)) and share[0] == 0
    assert entropy[0] == pytest.approx(-sum(t / n * math.log2(t / n) for t in times) / math.log2(n))
    assert [x[1] for x in (total, length, share, entropy)] == [0, 0, 0, 1]
    assert share[2] > 0.8 and total[3] >= 3
    with pytest.raises(ValueError):
        load_vocabulary("x.bin", b"")


def test_scripts():
    assert [script(t) for t in ("abc", "Привет abc", "日本語だ日本", "12 ?", "", "été", "สวัสดี")] == [
        "LATIN", "CYRILLIC", "CJK", "", "", "LATIN", "THAI",
    ]


def test_junk_is_rejected_and_clean_texts_stay(spark):
    r = random.Random(5)
    rows = [(k, prose(k, 60 + k % 60), ("en", None)[k % 2], "a") for k in range(300)]
    rows += [(1_000 + k, prose(7, 80), "en", "a") for k in range(400)]  # copies must not narrow a band
    junk = {
        2_000: " ".join("".join(r.choices("0123456789abcdef", k=40)) for _ in range(40)),
        2_001: " ".join(w + "\U00013080" for w in prose(900, 80).split()),
        2_002: " ".join(w + "%%%" for w in prose(901, 90).split()),
    }
    rows += [(k, t, "en", "a") for k, t in junk.items()]
    rows += [(3_000, None, "en", "a"), (3_001, "few words", "en", "a"), (3_002, prose(8, 9) + " " + prose(8, 9) + " " + prose(9, 14), "en", "a")]
    got = {x["doc_id"]: x for x in found(quality(documents(spark, rows, clash=True).drop("score")))}
    assert len(got) == len(rows)
    for k, x in got.items():
        assert x["kept"] == (k < 2_000), (k, x)
        assert x["base_failed"] == (k >= 3_000)
        assert bool(x["outside"]) == (2_000 <= k < 3_000)


def test_awkward_documents(spark):
    rows = awkward()
    got = found(quality(documents(spark, rows, clash=True)))
    assert len(got) == len(rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    expected = [(i, *plain_counts(t or "")) for i, t, *_ in rows]
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((x["doc_id"], *(x[c] for c in names)) for x in got), key=order) == sorted(expected, key=order)
    assert found(quality(documents(spark, rows).filter("false"))) == []


def test_rows_are_measured_where_they_are(spark):
    plan = measured(documents(spark, awkward()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

"""Small documents with every awkward case, and brute-force versions."""

import random
import unicodedata

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that operators use inside, as further columns of the input
CLASHING = (
    "row id hash key size target taken finish kept keep_id lead first edge sha256 label score lang_pred "
    "band bucket print n total weight slice sent start spans"
).split()
WORDS = [a + b + c for a in ("ka", "lo", "mi", "ru", "se", "to") for b in ("na", "ve", "di", "po") for c in ("", "r", "st", "m")]


def prose(seed, count):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(count))


def changed(text, places):
    """The text with other words at the given places."""
    words = text.split()
    for place in places:
        words[place] = f"zz{place}"
    return " ".join(words)


#: Scripts without blanks: letters to draw from, by name.
LETTERS = {
    "Chinese": [chr(0x4E00 + 37 * k) for k in range(400)],
    "Japanese": [chr(0x3042 + k) for k in range(80)] + [chr(0x5000 + 53 * k) for k in range(200)],
    "Thai": [chr(0x0E01 + k) for k in range(46)] + [chr(0x0E48), chr(0x0E34)],
}


def unspaced(script, seed, count, stop="。"):
    """So many letters of a script, with a stop after every 17."""
    draw = random.Random(f"{script}{seed}")
    return "".join(draw.choice(LETTERS[script]) + (stop if k % 17 == 16 else "") for k in range(count))


def plain_words(text):
    """The words of a text, character by character: an independent version of the operators' words."""
    words, held = [], ""
    for c in text.lower():
        name = unicodedata.name(c, "")
        alone = name.startswith(("CJK UNIFIED", "IDEOGRAPHIC", "HIRAGANA", "KATAKANA LETTER", "THAI CHARACTER", "KATAKANA-HIRAGANA"))
        part = c.isalnum() if c < "\x80" else unicodedata.category(c)[0] not in "PZ" and c not in "\ufeff\u200b"
        if held and (alone or not part):
            words.append(held)
            held = ""
        if part and alone:
            words.append(c)
        elif part:
            held += c
    return [*words, held] if held else words


def documents(spark, rows, clash=False):
    """rows: (doc_id, text[, lang[, source]])"""
    full = [(*r, *(None,) * (4 - len(r)))[:4] for r in rows]
    df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in full], DOCS)
    if clash:
        for k, name in enumerate(CLASHING):
            df = df.selectExpr("*", f"{k} as `{name}`")
    return df


def awkward():
    """Nulls, empty, white, letterless and very long texts, repeated rows, equal ids, unusual letters."""
    long_text = prose(1, 40_000)
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, "  \n\t ", None, None),
        (4, "1234 ... !!!", "en", "b"),
        (5, "one", "en", "b"),
        (6, long_text, "en", "a"),
        (7, prose(2, 60), "de", "a"),
        (7, prose(2, 60), "de", "a"),
        (7, prose(3, 60), "de", "b"),
        (None, prose(2, 60), None, "a"),
        (None, None, None, None),
        (8, "ГДЕ здесь 日本語 😀 naïve İstanbul", "fr", "c"),
        (9, "x" * 200_000, "en", "c"),
        (10, changed(long_text, [5]), "en", "c"),
    ]


def found(df):
    return [r.asDict(recursive=True) for r in df.collect()]

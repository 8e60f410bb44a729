import textwrap
import base64
import hashlib
import os
import pathlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from llm_helpers import awkward, documents, found, prose
from pyspark.sql import functions as F

from duelmetrics.llm.licence_texts import known
from duelmetrics.llm import chat, licence_texts, license_scan, mixing, warc
from duelmetrics.llm.registry import ORACLES

# --- mixing -----------------------------------------------------------------------


def filled(totals, weights, budget):
    """Targets by sharing again and again what full sources can't take."""
    target, full = dict.fromkeys(totals, 0.0), set()
    while True:
        left = budget - sum(2 * totals[s] for s in full)
        open_weight = sum(weights[s] for s in totals if s not in full)
        if not open_weight:
            break
        for s in totals:
            target[s] = 2 * totals[s] if s in full else left * weights[s] / open_weight
        over = {s for s in totals if s not in full and target[s] > 2 * totals[s]}
        if not over:
            break
        full |= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_mix_meets_its_targets(spark, seed):
    draw = random.Random(seed)
    names = [None, "a", "B", "z", "é", "hot"][: 2 + seed]
    rows = [
        (k, prose(k, draw.choice([0, 1, 3, 30, 200])), "en", "hot" if k % 3 == 0 else draw.choice(names))
        for k in range(600)
    ]
    got = found(mixing.mix_counts(documents(spark, rows).repartition(7)))
    again = found(mixing.mix_counts(documents(spark, rows[::-1]).repartition(3)))
    assert sorted(map(str, got)) == sorted(map(str, again))
    source = {k: s for k, _, _, s in rows}
    totals, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        s = source[r["doc_id"]]
        totals[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    order = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + [None] * (None in totals)
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    want = filled(totals, weights, 1.5 * sum(totals.values()))
    assert all(target[s] == pytest.approx(want[s]) for s in want)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert all(r["source_size"] == totals[source[r["doc_id"]]] for r in got)
    # what is taken was sent before the moment at which the budget is spent
    finish = [(r["finish"], r["taken"]) for r in got if r["size"]]
    assert max(f for f, t in finish if t) <= min((f for f, t in finish if not t), default=np.inf) * 2


def test_slices_of_a_queue_give_the_same_mix(spark):
    rows = [(k, prose(k, 1 + k % 20), "en", "hot" if k % 3 else f"s{k % 5}") for k in range(800)]
    size = mixing.word_count()
    one, many = (
        {r["row"]["doc_id"]: r["taken"] for r in found(mixing.mix(documents(spark, rows), size=size, slice_rows=n))}
        for n in (10**6, 5)
    )
    assert one == many


def test_mix_equals_its_sql(spark):
    draw = random.Random(11)
    names = ["a", "b", "c", "d", None]
    rows = [
        (None if k % 4 == 0 else k, prose(k, draw.choice([0, 1, 9, 70])), "en", "hot" if k % 3 else draw.choice(names))
        for k in range(900)
    ]
    got = found(mixing.mix_counts(documents(spark, rows)))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    cursor = con.execute(ORACLES["op7_mixing"])
    names = [d[0] for d in cursor.description]
    want = [dict(zip(names, row)) for row in cursor.fetchall()]
    key = lambda r: (str(r["doc_id"]), r["finish"], r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, want))


@pytest.mark.parametrize("seed", range(6))
def test_the_sorted_queue_tells_when_the_budget_is_spent(spark, seed):
    """Against serving the sources step by step, from one send to the next."""
    draw = random.Random(seed)
    sources = [
        (float(draw.choice([1, 2, 5])), [draw.randint(1, 40) for _ in range(draw.choice([1, 5, 60]))]) for _ in range(7)
    ]
    rows = []
    for s, (weight, sizes) in enumerate(sources):
        for k in range(len(sizes)):
            rows.append((s, s * 1000 + k, sizes[k], sum(sizes[: k + 1]), sum(sizes), weight))
    df = spark.createDataFrame(rows, "source int, order0 long, size long, sent long, total long, weight double")
    queue = mixing.cut(mixing.sends(df.repartition(5), 2))
    events = sorted({(r[3] + c * r[4]) / r[5] for r in rows for c in (0, 1)})
    full = sum(2 * sum(sizes) for _, sizes in sources)
    for budget in (0.0, 1.0, full * 0.3, full * 0.75, full - 1.0, float(full), full + 9.0):
        served, at = 0.0, 0.0
        for event in events:
            rate = sum(w for w, sizes in sources if 2 * sum(sizes) / w > at)
            if served + rate * (event - at) >= budget - 1e-9:
                at += (budget - served) / rate
                break
            served, at = served + rate * (event - at), event
        weight = sum(w for w, _ in sources)
        assert mixing.spent_at(queue, budget, weight) == pytest.approx(at, abs=1e-9)
    assert mixing.spent_at(queue.filter("false"), 5.0, 1.0) == 0.0


def test_the_sort_feeds_the_cut(spark):
    df = documents(spark, [(k, "a b", "en", f"s{k % 3}") for k in range(50)])
    narrow = df.selectExpr(
        "source", "2L as size", "doc_id as order0", "2L as sent", "50L as total", "1.0D as weight"
    )
    plan = mixing.sends(narrow, 2)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(finish" in plan and "Sort [finish" in plan


def test_rows_without_id_spread_over_slices(spark):
    df = spark.range(100_000).selectExpr("cast(null as bigint) as doc_id", "concat('w', id, ' v') as text", "'x' as source")
    placed = mixing._with_slice(df.select(*[c.alias(f"order{k}") for k, c in enumerate(mixing.shuffled_order())]), 8)
    sizes = [r["count"] for r in placed.groupBy("slice", "cell").count().collect()]
    assert len(sizes) == 256 and max(sizes) < 600
    got = mixing.mix_counts(df).agg(F.sum("taken").alias("taken"), F.max("taken").alias("most"), F.count("*").alias("n"))
    assert got.first().asDict() == {"taken": 300_000, "most": 4, "n": 100_000}


def test_mix_keeps_columns_with_names_of_its_own(spark):
    df = documents(spark, [(k, "a b c") for k in range(20)]).selectExpr("*", "'mine' as Taken", "7 as mix_taken", "1 as finish")
    left = mixing.take_mix(df)
    assert left.columns == [*df.columns, "size", "source_size", "target", "mix_mix_taken", "mix_finish"]
    assert {(r["Taken"], r["mix_taken"], r["finish"]) for r in found(left)} == {("mine", 7, 1)}
    assert sum(r["mix_mix_taken"] for r in found(left)) == 90


def test_mix_plan_has_no_python_and_no_cross_join(spark):
    plan = mixing.mix_counts(documents(spark, awkward()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_mix_awkward_rows(spark):
    df = documents(spark, awkward(), clash=True)
    got = found(mixing.mix_counts(df))
    assert len(got) == len(awkward())
    assert all(r["taken"] == 0 for r in got if r["doc_id"] in (1, 2, 3))
    left = mixing.take_mix(df)
    assert {"doc_id", "text", "lang", "source", "taken", "finish"} <= set(left.columns)
    assert left.filter("taken <= 0").count() == 0 and left.count() == sum(r["taken"] > 0 for r in got)
    assert found(mixing.mix_counts(df.filter("false"))) == []
    assert found(mixing.mix_counts(documents(spark, [(1, None), (2, "")])))[0]["target"] == 0.0


# --- licences ----------------------------------------------------------------------


def test_licence_scan_equals_its_sql(spark):
    mit = license_scan.known()[0][1]
    variants = [
        mit,
        "Copyright (c) 2020 Ann\n" + mit.upper(),
        mit.replace(",", ";").replace("sublicense", "sub-licence").replace("\n", "\r\n"),
        f"{prose(1, 9)}\n\n{mit.split(chr(10) + chr(10))[0]}\n\n{prose(2, 9)}",
        f"# {prose(3, 5)}\n// Released under the MIT Licence.\n\nLicensed under CC BY-NC v4.0",
        mit[:-9],
        prose(4, 50),
    ]
    rows = [*awkward(), *[(100 + k, v) for k, v in enumerate(variants)]]
    df = documents(spark, rows, clash=True)
    got = found(license_scan.licences(df))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    cursor = con.execute(ORACLES["op6_license_scan"])
    names = [d[0] for d in cursor.description]
    assert sorted(map(str, ({n: r[n] for n in names} for r in got))) == sorted(
        str(dict(zip(names, row))) for row in cursor.fetchall()
    )
    whole = {(r["doc_id"], r["licence"]) for r in got if r["scope"] == "text"}
    assert whole == {(100, "MIT"), (101, "MIT"), (102, "MIT")}
    lines = {(r["doc_id"], r["licence"], r["first"]) for r in got if r["scope"] == "line"}
    assert lines == {(104, "MIT", 1), (104, "CC-BY-NC-4.0", 3)}
    assert found(license_scan.licences(df.filter("false"))) == []


def test_licence_files_as_projects_ship_them(spark):
    plain = licence_texts.TEXTS
    shipped = [
        ("MIT", f"MIT License\n\nCopyright (c) 2020 Ann Bell\n\n{plain['MIT']}\n"),
        ("MIT", f"The MIT License (MIT)\n\nCopyright © 2020 Ann Bell\n\n{plain['MIT']}\n"),
        ("ISC", f"ISC License\n\nCopyright (c) 2020, Ann Bell\n\n{plain['ISC']}"),
        ("BSD-3-Clause", f"BSD 3-Clause License\n\nCopyright (c) 2020\nAll rights reserved.\n\n{plain['BSD-3-Clause']}"),
        ("BSD-2-Clause", re.sub(r"(?m)^[12]\.", "*", plain["BSD-2-Clause"])),
        ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
        ("LGPL-2.1", "// SPDX-License-Identifier: LGPL-2.1-or-later"),
        ("Zlib", "SPDX-License-Identifier: Zlib"),
    ]
    folder = pathlib.Path(licence_texts.__file__).parent / "licences"
    shipped += [(x, (folder / f"{x}.txt").read_text()) for x in licence_texts.LONG]
    apache = (folder / "Apache-2.0.txt").read_text()
    shipped += [("Apache-2.0", apache.split("APPENDIX")[0]), ("Apache-2.0", apache.replace("[yyyy]", "2020"))]
    got = found(license_scan.licences(documents(spark, [(k, text) for k, (_, text) in enumerate(shipped)])))
    whole = {r["doc_id"]: r["licence"] for r in got if r["scope"] == "text"}
    assert whole == {k: licence for k, (licence, _) in enumerate(shipped)}


def test_own_licence_texts(spark):
    own = license_scan.licence_digests(spark, [("house", "House rules: be kind."), ("house-2", "HOUSE RULES be kind")])
    got = found(license_scan.scan(documents(spark, [(1, "House rules — be kind!")]), own))
    assert {(r["licence"], r["scope"]) for r in got} == {("house", s) for s in license_scan.SCOPES}


# --- archives -----------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string"


def pages(spark):
    rows = [(k, f"http://x/{k}", f"<p>{k % 7}</p>" if k % 3 else "<b>hot</b>") for k in range(300)]
    rows += [(400, "http://x/é\r\nX: y", "a\r\n\r\nWARC/1.1\r\n\r\nb é日😀"), (401, None, None), (402, "u", "")]
    rows += [(500, "u", "twice"), (500, "u", "twice"), (500, "u", "other"), (None, "u", "twice"), (None, None, "lone")]
    rows += [(600, "u", "long " * 100_000)]
    return rows, spark.createDataFrame(rows, PAGES)


def archives(path):
    return [f for f in pathlib.Path(path).rglob("part-*") if f.stat().st_size]


def test_archives_read_back(spark):
    rows, df = pages(spark)
    df = df.selectExpr("*", "1 as key", "2 as sha1", "3 as copy", "4 as records")
    got = found(warc.archive_round_trip(df))
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    assert len(got) == len(rows)
    by_digest = defaultdict(list)
    for r in got:
        by_digest[r["payload_digest"]].append(r)
    for html, ids in groups.items():
        data = html.encode()
        records = by_digest[base64.b32encode(hashlib.sha1(data).digest()).decode()]
        assert len(records) == len(ids) and {r["payload_bytes"] for r in records} == {len(data)}
        original = max((i for i in ids if i is not None), default=None)
        responses = [r for r in records if r["record_type"] == "response"]
        assert [r["page_id"] for r in responses] == [original] and responses[0]["refers_to"] is None
        assert all(r["refers_to"] == original for r in records if r["record_type"] == "revisit")
    assert found(warc.archive_round_trip(df.filter("false"))) == []


def test_archives_keep_payloads_and_least_size(spark, tmp_path):
    rows, df = pages(spark)
    path = f"{tmp_path}/archives"
    warc.write_archives(df, path, least_bytes=7, file_bytes=5000)
    got = found(warc.read_archives(spark, path))
    files = archives(path)
    assert len(files) > 1
    for file in files:
        data = file.read_bytes()
        members = 0
        while data:  # each record is a member of its own
            member = zlib.decompressobj(wbits=31)
            record = member.decompress(data)
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            used, data = len(data) - len(member.unused_data), member.unused_data
            members += 1
        assert file.stat().st_size <= 5000 or members == 1
    assert sum(r["record_type"] == "revisit" for r in got) == sum(
        max(0, sum((r[2] or "") == h for r in rows) - 1) for h in {r[2] or "" for r in rows} if len(h.encode()) >= 7
    )
    want = {str(p): h or "" for p, _, h in rows if p != 500}
    assert all(want[str(r["page_id"])] == r["payload"] for r in got if r["record_type"] == "response" and r["page_id"] not in ("500", None))
    long_page = next(r for r in got if r["page_id"] == "400")
    assert long_page["url"] == "http://x/é%0D%0AX: y"


def test_a_damaged_archive_is_refused(spark, tmp_path):
    _, df = pages(spark)
    path = f"{tmp_path}/archives"
    warc.write_archives(df.filter("page_id < 9"), path)
    largest = max(archives(path), key=lambda f: f.stat().st_size)
    os.truncate(largest, largest.stat().st_size - 30)
    crc = largest.with_name(f".{largest.name}.crc")
    os.remove(crc) if crc.exists() else None
    with pytest.raises(Exception, match="ends within"):
        warc.read_archives(spark, path).collect()


def test_a_record_of_16_mb_ends_with_an_empty_member(spark, tmp_path):
    draw = random.Random(3)
    html = draw.randbytes(6 << 20).hex() + "x" * (6 << 20)
    df = spark.createDataFrame([(1, "u", html), (2, "v", "short"), (3, "w", html)], PAGES)
    warc.write_archives(df, f"{tmp_path}/archives")
    got = {r["page_id"]: r for r in found(warc.read_archives(spark, f"{tmp_path}/archives"))}
    assert got["3"]["payload"] == html and got["2"]["payload"] == "short"
    assert got["1"]["record_type"] == "revisit" and got["1"]["payload_bytes"] == len(html)


def test_revisits_resolve_by_record_id(spark, tmp_path):
    rows, df = pages(spark)
    path = f"{tmp_path}/archives"
    warc.write_archives(df, path, date=F.concat(F.lit("2025-02-0"), F.coalesce("page_id", F.lit(0)) % 9 + 1))
    records = warc.read_archives(spark, path)
    got = found(warc.resolve_revisits(records))
    by_id = {r["record_id"]: r for r in found(records)}
    assert len(got) == len(rows) == len(by_id)
    for r in got:
        original = by_id.get(r["refers_to"], {})
        assert (r["record_type"] == "revisit") == bool(original)
        assert r["original_id"] == original.get("page_id") and r["original_url"] == original.get("url")
        assert r["date"] == f"2025-02-0{int(r['page_id'] or 0) % 9 + 1}"
    hot = next(r for r in got if r["page_id"] == "0")["refers_to"]
    for broken in (
        records.filter(F.col("record_id") != hot),
        records.withColumn("payload_digest", F.when(F.col("record_id") == hot, "A").otherwise(F.col("payload_digest"))),
        records.withColumn("payload_bytes", F.col("payload_bytes") + (F.col("record_id") == hot).cast("long")),
    ):
        with pytest.raises(Exception, match="no response with the payload"):
            found(warc.resolve_revisits(broken))


def test_archives_need_no_more_partitions_than_the_session_sets(spark):
    rows, df = pages(spark)
    keyed = df.selectExpr("*", "cast(page_id as string) as key")
    joined = warc.spread_join(keyed, keyed.groupBy("html").agg(F.min("url").alias("least")), ["html"], by="key")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    sizes = {int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\)", plan)}
    assert sizes <= {int(spark.conf.get("spark.sql.shuffle.partitions"))}
    least = {}
    for _, url, html in rows:
        least[html] = min(filter(None, (least.get(html), url)), default=None)
    got = found(joined)
    assert len(got) == df.count()
    assert all(r["least"] == (least[r["html"]] if r["html"] is not None else None) for r in got)


# --- chat ---------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string"
needs_tokenizer = pytest.mark.skipif(not os.path.exists(chat.TOKENIZER), reason="needs the tokenizer")


def test_escaping_reads_back():
    draw = random.Random(5)
    parts = ["\\", "#", "##", "###", "####", "</turn>", "<", "</", " ", "\n", "a", "é", "日😀", ":", "### Assistant: "]
    for _ in range(3000):
        turns = [
            (draw.choice(["user", "assistant", "a:b\n#<", ""]), "".join(draw.choices(parts, k=draw.randint(0, 9))))
            for _ in range(draw.randint(1, 4))
        ]
        rendered = "".join(chat.render_turn(r, t)[0] for r, t in turns)
        assert list(chat.read_turns(rendered)) == turns
    with pytest.raises(ValueError, match="no turn"):
        list(chat.read_turns("### user:\nno end"))


@needs_tokenizer
def test_masks_cover_the_loss_text_and_cuts_change_no_token():
    with open(chat.TOKENIZER, encoding="utf-8") as file:
        tokenizer = chat.load_tokenizer(file.read())
    draw = random.Random(6)
    parts = [" ", "\n", "\n\n", "word", "é", "日😀", "###", "<|endoftext|>", "\\", "12"]
    for _ in range(500):
        turns = [
            (draw.choice(["user", "assistant"]), "".join(draw.choices(parts, k=draw.randint(0, 12))))
            for _ in range(draw.randint(1, 5))
        ]
        text, spans = "", []
        for role, said in turns:
            piece, begin, end = chat.render_turn(role, said)
            if role == "assistant" and end > begin:
                spans.append((len(text) + begin, len(text) + end))
            text += piece
        encoded = tokenizer.encode(text, add_special_tokens=False)
        offsets = np.array(encoded.offsets).reshape(-1, 2)
        mask, loss = chat.intersect(spans, offsets[:, 0], offsets[:, 1])
        assert "".join(chat.unescape(text[a:b]) for a, b in loss) == "".join(t for r, t in turns if r == "assistant")
        assert mask.tolist() == [any(a < e and s < b for a, b in spans) for s, e in encoded.offsets]
        apart = [i for r, t in turns for i in tokenizer.encode(chat.render_turn(r, t)[0], add_special_tokens=False).ids]
        assert apart == encoded.ids and tokenizer.decode(encoded.ids) == text


@needs_tokenizer
def test_conversations_read_back(spark):
    draw = random.Random(7)
    rows = [
        (k, turn, draw.choice(["user", "assistant", "system", None]), draw.choice([None, "", "hi", prose(k, 30), "é日 </turn> ###"]))
        for k in range(60)
        for turn in range(draw.randint(1, 6))
    ]
    rows += [(100, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(1300)]  # several chunks
    rows += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (200, 5, "assistant", "x" * 300_000)]
    df = spark.createDataFrame(rows, TURNS).repartition(5).selectExpr("*", "1 as chunk", "2 as part", "3 as formatted")
    got = {r["conv_id"]: r for r in found(chat.formatted_digests(df))}
    groups = defaultdict(list)
    for conv_id, turn, role, text in rows + [(-7, k, r, chat.CONTROL_TEXT) for k, r in enumerate(("user", "assistant"))]:
        groups[conv_id].append((float("inf") if turn is None else turn, role or "", text or ""))
    assert set(got) == set(groups)
    for conv_id, turns in groups.items():
        turns.sort(key=lambda t: t[0])
        every = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        r = got[conv_id]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(every.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(chat.render_turn(a, t)[0]) for _, a, t in turns)
    parts = chat.format_conversations(df.drop("chunk", "part", "formatted"), chunk_chars=1000)
    assert parts.filter("conv_id = 100").count() > 3
    assert {str(r) for r in chat.read_back(parts).filter("conv_id = 100").collect()} == {
        str(r) for r in chat.read_back(chat.format_conversations(df)).filter("conv_id = 100").collect()
    }
    assert [r["conv_id"] for r in found(chat.formatted_digests(df.filter("false")))] == [-7]
    assert parts.filter(F.size("token_ids") != F.size("loss_mask")).count() == 0


def rewrapped(text, width):
    paragraphs = [p for p in re.split(r"\n\s*\n", text) if p.strip()]
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False) for p in paragraphs)


def test_line_breaks_do_not_decide_on_a_licence(spark):
    """Known texts at widths 40 to 120 and with a line a paragraph; one appendix is too wide for 40."""
    widths = (40, 50, 60, 64, 68, 72, 80, 120, 1_000_000)
    rows = [(n, rewrapped(t, w), name, w) for name, t in known() if len(t) >= 200 for n, w in enumerate(widths)]
    docs = spark.createDataFrame([(k, r[1]) for k, r in enumerate(rows)], "doc_id bigint, text string").repartition(16)
    got = {r["doc_id"] for r in license_scan.licences(docs).filter("scope = 'text'").collect()}
    missed = {(rows[k][2], rows[k][3]) for k in range(len(rows)) if k not in got}
    assert missed <= {("Apache-2.0", 40)}
    kept = spark.createDataFrame([("copyright notice and this",), ("Copyright (c) 2020 Ann",), ("Copyright Ann Lee",), ("COPYRIGHT HOLDERS BE",)], "x string")
    assert [r[0] for r in kept.select(license_scan.normal_line(F.col("x"))).collect()] == ["copyright notice and this", "", "", "copyright holders be"]

"""Line dedup, decontamination, URLs, chat and quality rules against brute force and on odd rows."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from folioflow.llm import chat_format, decontaminate, line_dedup, quality_rules, url_filter

KEY = {i: i + 32 for i in range(65, 91)}


def plain_lines(rows, min_docs, keep_first=False):
    """Lines of each document that stay, the slow way."""
    keys = [[x.strip(" \t\n\x0b\x0c\r").translate(KEY) for x in (t or "").split("\n")] for _, t in rows]
    holders = defaultdict(set)
    for (d, t), ks in zip(rows, keys):
        for k in ks:
            holders[k].add((d, t))
    out, seen = [], set()
    for (d, t), ks in sorted(zip(rows, keys), key=lambda x: (x[0][0] is not None, x[0][0])):
        left, own = [], set()
        for line, k in zip((t or "").split("\n"), ks):
            common = k and len(holders[k]) >= min_docs
            first = keep_first and k not in seen and k not in own
            own.add(k)
            if not common or first:
                left.append(line)
        seen |= own
        out.append((d, "\n".join(left)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("parts", [1, 7])
def test_lines(spark, docs, keep_first, parts):
    # One line in all documents and one in a third: their runs go over several ranges.
    rows = [(i, f"Hot line\n own {i} \n" + ("third\nTHIRD " if i % 3 == 0 else "") + ("\nfew" if i < 4 else "")) for i in range(200)]
    df = docs(*rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for min_docs in (2, 5, 150):
            left = line_dedup.drop_lines(df, line_dedup.line_bitmaps(df, min_docs, keep_first=keep_first))
            assert left.columns == df.columns
            assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == plain_lines(rows, min_docs, keep_first)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lines_odd(docs, odd_rows):
    df = docs(*odd_rows, *((i, "shared\nx") for i in range(20, 30)))
    got = line_dedup.digest(df, min_docs=10).collect()
    assert len(got) == len(odd_rows) + 10
    assert all(r.n_dropped == (2 if r.doc_id and 20 <= r.doc_id < 30 else 1 if r.doc_id == 4 and r.n_lines == 3 else 0) for r in got)
    assert line_dedup.digest(df.limit(0)).count() == 0
    null = line_dedup.drop_lines(df, line_dedup.line_bitmaps(df)).filter("doc_id = 1").first()
    assert null.text is None


def test_lines_beside_columns_of_any_name(spark):
    names = ["_m_doc", "_m_key", "_text_key", "_keep", "keep", "high", "low", "places", "kind"]
    rows = [(i, f"common\nown {i}", *range(len(names))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{n} bigint" for n in names))
    left = line_dedup.drop_lines(df, line_dedup.line_bitmaps(df))
    assert left.columns == df.columns and sorted(r.text for r in left.collect()) == sorted(f"own {i}" for i in range(12))


def plain_hits(text, items, window=13):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(KEY))
    hit, found = set(), set()
    for item, t in items:
        iw = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(KEY))
        size = min(window, len(iw))
        for i in range(len(iw) - size + 1) if iw else []:
            for j in range(len(ws) - size + 1):
                if ws[j : j + size] == iw[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item))
    return len(ws), len(hit), sorted(found)


def plain_near(text, items, window, reach):
    ws = decontaminate.words(text)
    found = set()
    for item, t in items:
        iw = decontaminate.words(t)
        for i in range(len(iw) - min(window, len(iw)) + 1) if iw else []:
            part = iw[i : i + window]
            rare = min(part, key=ws.count)
            if any(all(w in ws[max(0, j - reach) : j + reach + 1] for w in part) for j, x in enumerate(ws) if x == rare):
                found.add(str(item))
    return sorted(found)


def test_decontamination(spark, docs, odd_rows, monkeypatch):
    passage = " ".join(f"w{i}" for i in range(20))
    items = [(1, passage), (2, "a b"), (3, None), (4, "!?"), (4, "no id"), (None, "other text"), (12, "w3 w1 q")]
    rows = [*odd_rows, (20, f"x, {passage.upper()} y"), (21, "w1 q q w3 z " * 3), (22, " ".join(f"w{i}" for i in range(12))), (23, "w9 " * 50 + passage)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(((d, *plain_hits(t, [("" if i is None else i, x) for i, x in items])) for d, t in rows), key=repr)
    for block in (decontaminate.BLOCK_BYTES, 40):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = decontaminate.find(decontaminate.build_index(docs(*rows)), bench).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=repr) == want
    got = decontaminate.find(decontaminate.build_index(docs(*rows)), bench, window=3, reach=4).collect()
    near = {r.doc_id: r.near for r in got if r.doc_id and r.doc_id >= 20}
    assert near == {d: plain_near(t, items, 3, 4) for d, t in rows if d and d >= 20}
    assert decontaminate.digest(docs((1, "x")).limit(0), bench).count() == 0
    assert [r.n_hit for r in decontaminate.digest(docs((1, "x")), bench.limit(0)).collect()] == [0]
    left = decontaminate.without_contaminated(docs(*rows), bench)
    assert left.columns == docs(*rows).columns
    bad = {d for d, n, h, _ in want if h and 20 * h >= n}
    assert {20, 23} & bad == {r for r in (20, 23)} and not bad & {r.doc_id for r in left.filter("doc_id >= 20").collect()}


def test_urls(spark):
    urls = ["https://m.free-bets.example.com/x", "http://casino-win.example.org/a?b#c", "HTTP://WWW.Example.com/en/1", "http://example.com/en/1", "http://adult.net/es/1", "no url", None, "", "x://a?b=porn", "http://essex.example.org/", "http://a.b/freedom-bets", "http://example.org/free/win"]
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)] + [(0, urls[0], "h", "v")], "page_id bigint, url string, html string, verdict string")
    got = url_filter.judge_urls(df).orderBy("page_id").collect()
    assert len(got) == len(urls) + 1
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert by[0] == ("m.free-bets.example.com", "/x", "com/", "allow")
    assert by[1] == ("casino-win.example.org", "/a", None, "block")
    assert by[2] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert by[3][2:] == ("example.com/en/", "block") and by[4][2:] == ("net/es/", "block")
    assert by[5] == by[6] == by[7] == ("", "", None, "allow") and by[8] == ("a", "", None, "allow")
    assert by[9][3] == "allow" and by[10][3] == "allow" and by[11][3] == "block"
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def plain_chat(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t, r is not None, r or "", x is not None, x or ""))
    convs = {c: tuple(sorted(v)) for c, v in convs.items()}
    return {c for c, v in convs.items() if not any(d != c and w[: len(v)] == v and (len(w) > len(v) or (d if d is not None else 1e9) < (c if c is not None else 1e9)) for d, w in convs.items())}


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, 0, None, "hi"), (5, 0, "user", None), (6, 0, "user", ""), (7, None, "user", "z"), (7, 0, "user", "hi"), (8, 0, "user", "hi"), (8, 0, "user", "hi"), (None, 0, "user", "n")]
    rows += [(20, i, "user", f"t{i}") for i in range(50)] + [(21, i, "user", f"t{i}") for i in range(37)] + [(22, i, "user", f"t{i + (i == 36)}") for i in range(37)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, n bigint, block string")
    for size in (512, 8):
        got = chat_format.collapse_and_render(df, block_turns=size).orderBy("conv_id", "part").collect()
        assert {r.conv_id for r in got} == plain_chat(rows)
        text = "".join(r.text for r in got if r.conv_id == 20)
        assert text == "".join(f"<|im_start|>user\nt{i}<|im_end|>\n" for i in range(50))
        assert all(len(re.findall("im_start", r.text)) <= size for r in got)
    assert chat_format.collapse_and_render(df.limit(0)).count() == 0


CHAT_DDL = "conv_id bigint, turn bigint, role string, text string"


def chat_rows(df):
    return sorted((tuple(r) for r in df.select("conv_id", "part", "n_turns", "text").collect()), key=repr)


def plain_render(rows, size=512):
    """Maximal conversations by comparing every pair of lists of turns."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append(((t is not None, t or 0), (role is not None, role or ""), (text is not None, text or "")))
    convs = {c: [(r, x) for _, r, x in sorted(turns)] for c, turns in convs.items()}
    for c, turns in convs.items():
        others = [(o, said) for o, said in convs.items() if o != c]
        if any(len(said) > len(turns) and said[: len(turns)] == turns for _, said in others):
            continue
        if any(said == turns and (c is None or o is not None and o < c) for o, said in others):
            continue
        shown = [f"<|im_start|>{r if known else 'unknown'}\n{x}<|im_end|>\n" for (known, r), (_, x) in turns]
        for part in range(0, len(turns), size):
            yield c, part // size, len(turns), "".join(shown[part : part + size])


def test_chat_on_ties(spark):
    """Turns of equal number stand by role and text in every conversation, whatever their hashes."""
    rows = []
    for i in range(40):
        rows += [(2 * i, 0, "user", f"a{i}"), (2 * i, 0, "user", f"b{i}"), (2 * i + 1, 0, "user", f"a{i}")]
    rows += [(100, 1, "user", "x"), (100, 1, "assistant", "y"), (101, 1, "assistant", "y"), (102, 1, "user", "x"), (103, None, None, None), (104, None, None, None), (104, None, "user", None)]
    rows += [(105, 3, "user", "p" * 300 + "z"), (105, 3, "user", "p" * 300 + "z"), (106, 3, "user", "p" * 300 + "z")]
    df = spark.createDataFrame(rows, CHAT_DDL).repartition(6)
    got = chat_rows(chat_format.collapse_and_render(df))
    assert got == sorted(plain_render(rows), key=repr)
    assert {r[0] for r in got} == {2 * i for i in range(40)} | {100, 102, 104, 105}
    conversations = df.toArrow()  # noqa: F841  the SQL reads it by name
    assert got == sorted(duckdb.sql(chat_format.ORACLE).fetchall(), key=repr)


def test_chat_parts_by_rank(spark):
    """Turns 500 to 529 are one row; 1,500 turns are three; a third of all rows without an id, and one repeated turn, spread over ranges."""
    rows = [(1, t, "user", f"t{t}") for t in range(500, 530)] + [(2, t, "user", f"u{t}") for t in range(1500)] + [(3, t, "user", f"u{t}") for t in range(1400)]
    rows += [(None, t % 7, "user", f"n{t % 40}") for t in range(3000)] + [(4, 5, "user", "same")] * 2500 + [(5, 5, "user", "same")] * 700
    rows += [(6, 0, "user", f"u{t}") for t in range(1500)]
    df = spark.createDataFrame(rows, CHAT_DDL).repartition(5)
    want = sorted(plain_render(rows), key=repr)
    assert chat_rows(chat_format.collapse_and_render(df, range_bytes=2000)) == want
    assert {r[0]: sum(w[0] == r[0] for w in want) for r in want} == {1: 1, 2: 3, None: 6, 4: 5, 6: 3}
    turns = chat_format.in_order(df, "conv_id", "turn", "role", "text", 2000)
    sizes = [r["count"] for r in turns.groupBy("slice").count().collect()]
    assert max(sizes) < 0.2 * len(rows)
    assert chat_rows(chat_format.collapse_and_render(df, block_turns=7)) == sorted(plain_render(rows, 7), key=repr)


def test_chat_is_native(spark):
    plan = chat_format.collapse_and_render(spark.range(3).selectExpr("id AS conv_id", "id AS turn", "'u' AS role", "'t' AS text"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality(docs, odd_rows):
    texts = [" ".join(f"é{i % 9}" for i in range(40)), "a b c d e f g h i j\n# a b c d e f g h\n# a b c d e f g h", " ".join(f"v{i}" for i in range(50))]
    rows = [*odd_rows, *((30 + i, t) for i, t in enumerate(texts))]
    got = sorted((tuple(r)[:6] for r in quality_rules.digest(docs(*rows)).collect()), key=repr)
    assert got == sorted(((d, *plain_measures(t)) for d, t in rows), key=repr)
    assert quality_rules.digest(docs((1, "x")).limit(0)).count() == 0


def test_hosts(spark):
    good, bad = " ".join(f"v{i}" for i in range(50)), "short"
    rows = [(i, good if i % 10 else bad, "fine") for i in range(100)] + [(200 + i, bad if i % 10 else good, "awful") for i in range(100)] + [(400, bad, "small"), (401, good, None)]
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    hosts = {r.host: r.host_failed for r in got}
    assert hosts["awful"] and not hosts["fine"] and not hosts[None]
    assert all(r.kept == (not r.base_failed and not hosts[r.host]) for r in got) and len(got) == len(rows)

from collections import Counter

from ledgerlake.llm.line_dedup import boilerplate, drop_boilerplate

from .data import SCHEMA, empty, odd, odd_rows

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, max_ratio, min_pages):
    pages, having = Counter(), Counter()
    for _, text, _, source, _ in rows:
        pages[source] += 1
        for line in {x for x in (text or "").split("\n") if x.strip(BLANKS)}:
            having[source, line] += 1
    found = Counter()
    for key, text, _, source, _ in rows:
        if text is None:
            found[key, None, 0, 0] += 1
            continue
        lines = text.split("\n")
        kept = [
            x
            for x in lines
            if not (having[source, x] >= min_pages and having[source, x] > max_ratio * pages[source])
        ]
        found[key, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return found


def result(table, **how):
    rows = drop_boilerplate(table, **how).collect()
    return Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in rows)


def test_against_plain_python(spark):
    rows = []
    for i in range(300):
        source = "big" if i % 3 else (f"s{i % 7}" if i % 2 else None)
        lines = ["Home", f"only {i}", f"often {i % 5}", " \t", ""] + ["twice"] * (i % 3)
        rows.append((i, "\n".join(lines[i % 2 :]), "en", source, 1))
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for ratio, pages in ((0.1, 3), (0.5, 1), (0.0, 2)):
        assert result(table, max_ratio=ratio, min_pages=pages) == brute(rows, ratio, pages)


def test_odd_rows(spark):
    table = odd(spark, n_lines="x", site=1, line=2, pages=3)
    assert result(table, min_pages=2) == brute(odd_rows(), 0.1, 2)
    assert drop_boilerplate(table).columns == [
        "doc_id", "text", "lang", "source", "n_chars", "site", "line", "pages", "n_lines", "n_dropped",
    ]


def test_empty(spark):
    assert drop_boilerplate(empty(spark)).count() == 0
    assert boilerplate(empty(spark)).count() == 0


def test_copies_are_one_page(spark):
    copied = "a story\ntold in two lines"
    rows = [(i, copied if i % 3 == 0 else f"Menu\nonly {i}", "en", "s", 1) for i in range(60)]
    rows += [(100 + i, copied if i < 3 else f"only {i}", "en", None, 1) for i in range(20)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = Counter()
    for key, text, *_ in rows:
        menu = text.startswith("Menu")
        kept = text.removeprefix("Menu\n")
        want[key, kept, text.count("\n") + 1, int(menu)] += 1
    assert result(table, different=True) == want
    assert result(table) == brute(rows, 0.1, 3) != want


def test_different_pages_against_plain_python(spark):
    texts = {}
    for i in range(200):
        lines = ["Home" * (i % 2), f"often {i % 9}", f"text {i % 70}", ""]
        texts[f"s{i % 3}" if i % 5 else None, "\n".join(lines)] = i
    rows = [(key, text, "en", source, 1) for (source, text), key in texts.items()]
    repeated = rows + [(1000 + i, *rows[i % 7][1:]) for i in range(150)]
    table = spark.createDataFrame(repeated, SCHEMA).repartition(5)
    got = {k: (t, n, d) for k, t, n, d in result(table, different=True)}
    assert {(k, *got[k]) for k, *_ in rows} == set(brute(rows, 0.1, 3))
    assert all(got[1000 + i] == got[rows[i % 7][0]] for i in range(150))


def test_different_pages_odd_rows(spark):
    got = result(odd(spark, site=1, line=2, page=3, lines=4), different=True, min_pages=2)
    assert sum(got.values()) == len(odd_rows()) and all(n == 0 for _, _, _, n in got)
    assert boilerplate(empty(spark), different=True).count() == 0

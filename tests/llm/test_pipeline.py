"""The pipeline, stage by stage, against plain Python; the registered queries."""

import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from ledgerlake.llm.mixing import mix
from ledgerlake.llm.queries import oracle_sql, queries
from ledgerlake.llm.small_tables import word_count
from ledgerlake.llm.storage import stored

from .test_jaccard_join import brute as brute_components
from .test_line_dedup import brute as brute_lines
from .test_mixing import fill
from .test_packing import expected_pieces
from .test_quality import brute_counts

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage is given, and what the last one returns."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        found.append(docs)
        docs = stored(stage(spark, docs, SF))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    return [*found, docs]


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_stage_order():
    names = ["quality_rules", "line_dedup", "jaccard_join", "source_mixing", "best_fit_packing"]
    assert [name for name, _ in corpus_pipeline.STAGES] == names


def test_quality_stage(spark, steps):
    given, kept = rows(steps[0]), set(rows(steps[1]))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = 0
    for row in given:
        n, _, _, _, again = brute_counts(row[1])
        if n < 50 or 100 * again > 50 * n:
            assert row not in kept
        elif row[0] in labels:
            wrong += (row in kept) != (labels[row[0]] == 1)
    assert kept <= set(given) and wrong <= 0.02 * len(labels)


def test_line_stage(steps):
    given = rows(steps[1])
    want = brute_lines(given, 0.1, 3)
    got = Counter((r[0], r[1]) for r in rows(steps[2]))
    assert got == Counter({(k, t): n for (k, t, _, _), n in want.items()})
    assert all(r[4] == len(r[1]) for r in rows(steps[2]))


def test_copies_survive_the_line_and_duplicate_stages(spark):
    """A group of copies that is a third of a source leaves one whole text."""
    copied = "a story of some length\nthat many pages tell\nin the same words"
    given = [
        (i, copied if i % 3 == 0 else f"own words {i} of page {i * i}", "en", "s", 0) for i in range(30)
    ]
    table = stored(spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long"))
    cleaned = stored(corpus_pipeline.boilerplate_lines(spark, table, SF))
    kept = corpus_pipeline.near_duplicates(spark, cleaned, SF)
    assert [r["doc_id"] for r in kept.collect() if r["text"] == copied] == [0]
    assert not [r for r in kept.collect() if not r["text"]]


def test_line_on_a_tenth_of_the_pages_goes_from_every_source(spark):
    """Rates around 10 % go and rates of 3 % stay, on every source."""
    given = []
    for source in range(12):
        for i in range(500):
            lines = [f"own words {i}"]
            if i < 40 + 2 * source:  # 8.0 to 12.4 %
                lines.append("Subscribe to our letter")
            if i % 33 == 0:
                lines.append("It was late.")
            given.append((1000 * source + i, "\n".join(lines), "en", f"s{source}", 0))
    # A small site: 4 of 50 pages are no more than chance, 10 are.
    for i in range(50):
        lines = [f"own words {i}"] + ["By chance."] * (i < 4) + ["Menu"] * (i < 10)
        given.append((90_000 + i, "\n".join(lines), "en", "small", 0))
    table = stored(spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long"))
    lines = Counter()
    for r in corpus_pipeline.boilerplate_lines(spark, table, SF).collect():
        lines.update(r["text"].split("\n")[1:])
    assert lines == {"It was late.": 12 * 16, "By chance.": 4}


def test_near_duplicate_stage(steps):
    given = rows(steps[2])
    want = {c for _, _, c in brute_components([r[:2] for r in given], 5, 80)}
    assert sorted(r[0] for r in rows(steps[3])) == sorted(want)
    assert set(rows(steps[3])) <= set(given)


def test_mixing_stage(steps):
    given = rows(steps[3])
    counts = Counter(r[0] for r in rows(steps[4]))
    sizes = {r[0]: len((r[1] or "").encode().split()) for r in given}
    total, taken = Counter(), Counter()
    for r in given:
        total[r[3]] += sizes[r[0]]
        taken[r[3]] += sizes[r[0]] * counts[r[0]]
    want = fill(dict(total))
    for s in total:  # so few documents that no choice may come nearer
        left = [sizes[r[0]] for r in given if r[3] == s and counts[r[0]] <= want[s] // max(total[s], 1)]
        short = round(want[s]) - taken[s]
        assert 0 <= short and (short <= 0.01 * want[s] or short < min(x for x in left if x))
    assert set(rows(steps[4])) <= set(given) and max(counts.values()) <= 2
    drawn = mix(steps[3], word_count(F.col("text")), shards=64).collect()
    assert counts == Counter({r["doc_id"]: r["copies"] for r in drawn if r["copies"]})


def test_packing_stage(spark, steps):
    packed = steps[5].collect()
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)
    assert got == expected_pieces(rows(steps[4]), 2048)
    lengths = Counter()
    for r in packed:
        lengths[r["sequence_id"]] += r["length"]
    assert max(lengths.values()) <= 2048
    whole = corpus_pipeline.run(spark, SF).collect()
    pieces = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in whole]
    assert Counter(pieces) == got


def test_user_columns_come_through(spark):
    """Columns named like an operator's own, or like that but for case, keep value and type."""
    own = {"quality": "good", "Kept": "yes", "n_lines": "x", "N_Dropped": "y", "N_words": "z", "size": "s", "shards": "t", "Target": "u"}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.withColumns({c: F.concat(F.lit(v), F.col("doc_id")) for c, v in own.items()})
    plain, given = docs, stored(extra)
    for name, stage in corpus_pipeline.STAGES[:4]:
        plain, given = stored(stage(spark, plain, SF)), stored(stage(spark, given, SF))
        assert given.dtypes == extra.dtypes, name
        for c, v in own.items():
            assert given.where(~F.col(c).eqNullSafe(F.concat(F.lit(v), F.col("doc_id")))).isEmpty(), (name, c)
        assert sorted(rows(given), key=repr) == sorted(rows(plain), key=repr), name


def compared(cells):
    return sorted(map(repr, cells))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_match_sql(spark, name):
    for scale in ("sf0.001", "sf0.01"):
        folder = f"/root/testdata/{scale}"
        connection = duckdb.connect()
        for table in ("documents", "pages", "embeddings"):
            connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
        want = connection.sql(oracle_sql()[name])
        columns = sorted(want.columns)
        got = queries()[name](spark, folder).select(*columns).collect()
        assert compared(map(tuple, got)) == compared(want.select(*columns).fetchall())


CONTRACT = {
    "op1": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op2": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op3": "doc_id bigint, quality double, kept boolean",
    "op4": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op5": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op6": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op7": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op9": "doc_id bigint, first_doc_id bigint, start int, length bigint, kept boolean",
    "op10": "doc_id bigint, source string, text string, n_lines bigint, n_dropped bigint",
    "op11": "page_id bigint, host string, path string, rule string, verdict string",
    "op12": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    "op13": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
}
#: The table that has a row for each of a query's rows; the others return other rows.
ROWS_OF = {f"op{n}": ("documents", "doc_id") for n in (1, 3, 4, 5, 6, 7, 8, 10, 12)} | {"op11": ("pages", "page_id")}


@pytest.mark.parametrize("operator", list(CONTRACT))
def test_query_results(spark, operator):
    (name,) = (n for n in entry_point.queries() if n.startswith(f"{operator}_"))
    result = entry_point.queries()[name](spark, SF)
    kinds = dict(result.dtypes)
    for column in CONTRACT[operator].split(", "):
        assert kinds[column.split()[0]] == column.split()[1]
    found = result.collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    if operator in ("op2", "op9"):
        assert {r["doc_id"] for r in found} <= set(docs)
    elif operator in ROWS_OF:
        table, key = ROWS_OF[operator]
        keys = spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()
        assert sorted(r[key] for r in found) == sorted(r[key] for r in keys)
    if operator == "op5":
        held = [r for r in found if r["held_out"]]
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in found)
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    if operator == "op8":
        assert all(r["size"] == len(docs[r["doc_id"]].encode()) + 1 for r in found)
        assert {r["law"] for r in found} == {"bytes"}

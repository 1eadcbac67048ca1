import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerlake.llm.queries import op12_token_alignment
from ledgerlake.llm.token_alignment import (
    Aligner,
    ByteLevelTokens,
    PieceTokens,
    aligned,
    pair_counts,
    with_pair_scores,
)

from .data import SCHEMA, empty, odd, odd_rows, prose

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "a\tb\n\n c  d   e ",
    "  two spaces first",
    "\n",
    " ",
    "▁ marks",
    "<0x41> and <|endoftext|> <s> </s> <unk>",
    "日本語のテキスト。 ไทย עברית",
    "👩‍👩‍👧 emoji ﬁ ½ İ ß é",
    "x" * 3000,
    "it's we'll they've I'm you'd 12345 3.14 !!! ??? ---",
    " nbsp　ideographic em",
]


def by_hand(texts):
    """Alignment of every text token by token, without windows."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte = {}
    others = 0
    for i in range(256):
        shown = 33 <= i <= 126 or 161 <= i <= 172 or i >= 174
        byte[chr(i if shown else 256 + others)] = i
        others += not shown
    found, totals = [], Counter()
    for text in texts:
        want = (" " + text).encode() if text else b""
        left = a.encode(" " + text, add_special_tokens=False).ids if text else []
        right = b.encode(text) if text else []
        pieces = [
            bytes(byte[c] for c in a.id_to_token(i)) for i in left
        ], [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
            else b.id_to_piece(i).replace("▁", " ").encode()
            for i in right
        ]
        if any(b"".join(p) != want for p in pieces):
            left, right, pieces = [], [], ([], [])
        spans = []
        for parts in pieces:
            at, own = 0, []
            for part in parts:
                own.append((at, at + len(part)))
                at += len(part)
            spans.append(own)
        links, j = [], 0
        for i, (start, end) in enumerate(spans[0]):
            while spans[1][j][1] <= start:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < end:
                links.append((left[i], right[k]))
                k += 1
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, before = [], 0
        for end in ends:
            groups.append(
                "|".join(
                    ",".join(str(x) for x, (s, e) in zip(ids, own) if before <= s and e <= end)
                    for ids, own in zip((left, right), spans)
                )
            )
            before = end
        totals.update(links)
        found.append((len(left), len(right), len(groups), links, ";".join(groups)))
    best = {}
    for (_, y), n in totals.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (
            n_a, n_b, n_groups, len(links),
            sum(totals[p] == best[p[1]] for p in links),
            sum(totals[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if n_a else "",
        )
        for n_a, n_b, n_groups, links, text in found
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_against_tokens_by_hand(spark, tmp_path):
    texts = ODD + [prose(60, i) for i in range(12)] + [x[1] for x in odd_rows()]
    texts += [texts[0], None, "", ODD[4] + " " + prose(30, 3)]
    rows = [(i, x, None, None, None) for i, x in enumerate(texts)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in op12_token_alignment(spark, str(tmp_path)).collect()}
    want = dict(enumerate(by_hand(texts)))
    assert got == want
    assert sum(v[0] == 0 for v in want.values()) >= 4  # null, empty, not given back


def test_real_texts(spark):
    path = "/root/testdata/sf0.001"
    texts = pq.read_table(f"{path}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    want = dict(zip(texts["doc_id"], by_hand(texts["text"]), strict=True))
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in op12_token_alignment(spark, path).collect()}
    assert got == want


def test_fast_ids_are_those_of_the_file():
    tokens = ByteLevelTokens(A)
    assert tokens.fast
    rng = random.Random(3)
    letters = "aeé ßñ日𝄞\n\t\r  '’\".,-0123456789sXt\x00\x85 ‍\U0001f469"
    texts = [t.decode("utf-8", "ignore") for t in tokens.bytes]  # every entry on its own
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ODD + [prose(300, 1)]
    exact = tokens.exact.encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in tokens.ids(texts)] == [e.ids for e in exact]


def test_forgetting_changes_nothing():
    texts = [prose(80, i) for i in range(30)] + ODD
    whole = Aligner(ByteLevelTokens(A), PieceTokens(B))
    short = Aligner(whole.a, whole.b, most=20)
    one = whole.batch(texts)
    for i, text in enumerate(texts):
        other = short.batch([text])
        assert other["groups"][0] == one["groups"][i]
        assert [int(other[c][0]) for c in COLUMNS[:4]] == [int(one[c][i]) for c in COLUMNS[:4]]
        s, e = one["offsets"][i : i + 2]
        assert dict(zip(other["pairs"], other["links"])) == dict(zip(one["pairs"][s:e], one["links"][s:e]))


def test_very_long_text():
    aligner = Aligner(ByteLevelTokens(A), PieceTokens(B))
    out = aligner.batch([" " * 1_200_000, "word " * 60_000, "é" * 150_000])
    assert (out["n_a"] > 0).all() and (out["n_links"] == out["n_a"] + out["n_b"] - out["n_groups"]).all()


@pytest.mark.parametrize("extra", [{}, {"groups": "x", "pairs": 1, "n_a": "y", "hash": 2, "KEY": 3}])
def test_odd_rows(spark, extra):
    found = aligned(odd(spark, **extra), A, B)
    scored = with_pair_scores(found, pair_counts(found))
    got = Counter((r["doc_id"], r["n_a"], r["groups"]) for r in scored.collect())
    assert sum(got.values()) == len(odd_rows())
    for doc_id, text, *_ in odd_rows():
        assert any(k[0] == doc_id and bool(k[1]) == bool(k[2]) for k in got)
        if not text:
            assert got[doc_id, 0, ""]


def test_empty(spark):
    found = aligned(empty(spark), A, B)
    assert with_pair_scores(found, pair_counts(found)).collect() == []
    blank = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None)], SCHEMA)
    found = aligned(blank, A, B)
    rows = with_pair_scores(found, pair_counts(found)).agg(F.sum("n_links"), F.sum("count_sum")).first()
    assert tuple(rows) == (0, 0)

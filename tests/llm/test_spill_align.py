"""Cross-tokenizer links and their corpus-wide counts against the libraries and plain loops."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import pieces, spill_align
from tidelog.llm.pieces import public_pieces
from tidelog.llm.queries import QUERIES
from tidelog.llm.spill_align import COUNTED, align, byte_letters, counted, highest, packed, public_tokenizer, unpacked

SF = "/root/testdata/sf0.001"
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def plain():
    """(groups, links) of a text by the two libraries and overlap of byte ranges."""
    tokenizers, sentencepiece = pytest.importorskip("tokenizers"), pytest.importorskip("sentencepiece")
    a = tokenizers.Tokenizer.from_file(public_tokenizer())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_pieces())
    letters = byte_letters()

    def run(text):
        if not text:
            return [], []
        raw = (" " + text).encode()
        one, two = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        one_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in one]
        two_bytes = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in two]
        if b"".join(one_bytes) != raw or b"".join(two_bytes) != raw:
            return [], []
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (one_bytes, two_bytes)]
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            groups.append((one[i:x], two[j:y]))
            i, j = x, y
        links = []
        for k, x in enumerate(one):
            links += [(x, y) for m, y in enumerate(two)
                      if max(ends[0][k] - len(one_bytes[k]), ends[1][m] - len(two_bytes[m])) < min(ends[0][k], ends[1][m])]
        return groups, links
    return run


def expected(plain, texts):
    found = [plain(t) for t in texts]
    total = Counter(x for _, links in found for x in links)
    most = {}
    for (_, b), n in total.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for groups, links in found:
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(total[x] == most[x[1]] for x in links), sum(total[x] for x in links), said))
    return out


def test_rows_of_all_kinds(docs, plain, monkeypatch):
    monkeypatch.setattr(spill_align, "SEGMENT", 7)
    monkeypatch.setattr(pieces, "CACHED", 50)
    r = random.Random(6)
    words = ["the", "token", "unbelievable,", "Übersee", "漢字", "x1y22", "don't", "<|endoftext|>", "<s>", "a\nb", "😀", "\x1c", "naïve"]
    texts = [None, "", " ", "  ", "\n", "one", " lead", "trail ", "a  b   c", "tab\t next", "line \n line", "has ▁ sign", "\x85 x", "e　 f"]
    texts += [" ".join(r.choice(words) for _ in range(r.randrange(1, 30))) for _ in range(40)]
    texts += ["".join(r.choice("ab '\n\t1é漢0.,") for _ in range(r.randrange(1, 50))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(None, "no id"), (5, "one"), (5, "one")]
    table = docs(rows).withColumn("run", F.lit(1)).withColumn("bucket", F.lit("x")).withColumn("groups", F.lit(2.5))
    want = expected(plain, [t for _, t in rows])

    def shown(df):
        return sorted((str(x.doc_id), x.n_a, x.n_b, x.n_groups, x.n_links, x.n_best, x.count_sum, x.groups) for x in df.collect())
    assert shown(align(table, public_tokenizer(), public_pieces())) == sorted((str(i), *w) for (i, _), w in zip(rows, want))
    monkeypatch.setattr(spill_align, "FAN_IN", 3)  # small runs, merged over several levels
    monkeypatch.setattr(spill_align, "RUN_RECORDS", 30)
    assert shown(align(table.repartition(3), public_tokenizer(), public_pieces(), buckets=5)) == sorted(
        (str(i), *w) for (i, _), w in zip(rows, want))
    assert align(docs([]), public_tokenizer(), public_pieces()).count() == 0
    none = align(docs([(1, None), (2, "▁")]), public_tokenizer(), public_pieces()).collect()
    assert sorted(tuple(x) for x in none) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_heap_merge_counts_and_marks_the_highest():
    r = random.Random(1)
    runs, want = [], Counter()
    for _ in range(9):
        own = Counter({r.randrange(40) << spill_align.SHIFT | r.randrange(30): r.randrange(1, 9) for _ in range(r.choice([0, 5, 400]))})
        want += own
        runs.append(packed(np.array(sorted(own.items()), COUNTED) if own else np.empty(0, COUNTED)))
    got = unpacked(counted(runs), COUNTED)
    assert got.tolist() == sorted(want.items())
    most = {}
    for pair, n in want.items():
        most[pair >> spill_align.SHIFT] = max(most.get(pair >> spill_align.SHIFT, 0), n)
    assert highest(got).tolist() == [n == most[p >> spill_align.SHIFT] for p, n in got.tolist()]


def test_long_texts(docs, plain):
    long = "word another, thing " * 30_000
    got = {x.doc_id: x for x in align(docs([(1, long), (2, "x" * 20_000), (3, " " * 5_000), (4, "é" * 9_000)]), public_tokenizer(),
                                      public_pieces()).collect()}
    groups, links = plain("word another, thing")
    assert got[1].n_links >= 30_000 * len(links) and got[1].count_sum > got[1].n_links
    for i, text in ((2, "x" * 20_000), (3, " " * 5_000), (4, "é" * 9_000)):
        one = expected_groups(plain, text)
        assert got[i].groups == one


def expected_groups(plain, text):
    import tokenizers
    a = tokenizers.Tokenizer.from_file(public_tokenizer())
    a.encode_special_tokens = True
    import sentencepiece
    b = sentencepiece.SentencePieceProcessor(model_file=public_pieces())
    one, two = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    letters = byte_letters()
    size = [[len(bytes(letters[c] for c in a.id_to_token(i))) for i in one],
            [1 if b.is_byte(i) else len(b.id_to_piece(i).replace("▁", " ").encode()) for i in two]]
    ends = [np.cumsum(s) for s in size]
    out, i, j = [], 0, 0
    for cut in np.intersect1d(*ends):
        x, y = np.searchsorted(ends[0], cut) + 1, np.searchsorted(ends[1], cut) + 1
        out.append(",".join(map(str, one[i:x])) + "|" + ",".join(map(str, two[j:y])))
        i, j = x, y
    return ";".join(out)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_query_over_the_given_documents(spark, plain):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    short = [d for d in rows if len(d.text or "") < 2500]  # the plain overlap test is quadratic
    folder = spark.createDataFrame(short)
    out = align(folder, public_tokenizer(), public_pieces(), digest=True)
    want = [(d.doc_id, *w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "")
            for d, w in zip(short, expected(plain, [d.text for d in short]))]
    assert sorted(map(tuple, out.collect())) == sorted(want)
    whole = QUERIES["op12_spill_alignment"](spark, SF)
    assert whole.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert whole.count() == len(rows)

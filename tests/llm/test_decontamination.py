from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from loanops.llm import decontamination

from .conftest import documents, prose


def items(number):
    draw = random.Random(1)
    return [(i, f"{prose(100 + i, draw.randint(8, 25), 2000)}. {prose(500 + i, draw.randint(5, 20), 2000)}.") for i in range(number)]


def pairs_of(index, texts):
    """(window, word) pairs and, by hand, the words of every window."""
    part = next(decontamination.lowered(pa.array(texts)))
    hashes, counts = decontamination.item_words(part)
    number = dict(zip(index.words.tolist(), index.number.tolist()))
    windows, first = [], 0
    for n in counts:
        own = hashes[first : first + n].tolist()
        windows += [{number[h] for h in own[at : at + 2 * index.segment] if h in number} for at in range(0, max(n, 1), index.segment) if n]
        first += n
    return windows


def test_search_finds_all_above_the_threshold():
    index = decontamination.build_index(items(60))
    draw = random.Random(2)
    texts = [prose(i, draw.randint(1, 400), 2000) for i in range(40)]
    texts += [f"{prose(i, 50, 2000)} {t} {prose(i, 30, 2000)}" for i, t in items(60)[::3]]
    windows = pairs_of(index, texts)
    window = np.concatenate([np.full(len(w), i) for i, w in enumerate(windows)]).astype(np.int64)
    word = np.concatenate([sorted(w) for w in windows]).astype(np.int64)
    dense = index.impact.reshape(len(index.words), len(index.ids))
    for threshold in (0.1, 0.3, 0.6, 0.95):
        own, item, score = decontamination.search(index, window, word, threshold)
        got = {(int(w), int(i)): s for w, i, s in zip(own, item, score)}
        want = {(w, i): s for w, words in enumerate(windows) if words for i, s in enumerate(dense[sorted(words)].sum(0)) if s >= threshold}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_sparse_tables_agree_with_dense_ones(monkeypatch):
    texts = pa.array([f"{prose(1, 40, 2000)} {t}" for _, t in items(40)])
    found = []
    for most in (1 << 22, 0):
        monkeypatch.setattr(decontamination, "MOST_DENSE", most)
        index = decontamination.build_index(items(40))
        found.append([h[:3] for part in decontamination.lowered(texts) for h in decontamination.contaminated(index, part)])
    assert found[0] == found[1] and len(found[0]) == 40


def test_split_item():
    assert decontamination.split_item("What is the capital of it?\nThe old town. It is big.") == ("What is the capital of it?\nThe old town.", " It is big.")
    assert decontamination.split_item("a b c d e f g h") == ("a b c d e ", "f g h")


def test_hits(spark):
    bench = items(50)
    benchmark = spark.createDataFrame([*bench, (900, None), (901, "too short"), (902, ""), (None, prose(77, 30, 2000) + ".")], "item_id long, text string")
    rows = []
    for i, text in bench[:20]:
        rows.append((i, f"{prose(i, 300 + i, 2000)}\n{text.upper()}\n{prose(1000 + i, 100, 2000)}", "en", "s"))
    for i, text in bench[20:30]:  # the question alone, or the answer alone
        rows.append((i, f"{prose(i, 200, 2000)} {text.split('. ')[i % 2]} {prose(i, 50, 2000)}", "en", "s"))
    rows += [(i, prose(3000 + i, 250, 2000), "en", "s") for i in range(100, 160)]
    rows.append((200, prose(77, 30, 2000), "en", "s"))
    hits = decontamination.benchmark_hits(documents(spark, rows), benchmark).collect()
    assert sorted((r["id"], r["item"]) for r in hits if r["id"] < 200) == [(i, i) for i in range(20)]
    assert [r["item"] for r in hits if r["id"] == 200] == [None]
    kept = decontamination.drop_contaminated(documents(spark, rows), benchmark)
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(20, 30), *range(100, 160)]


def test_short_items_and_scripts_without_spaces(spark):
    poem, town = "谁写了红楼梦？曹雪芹。", "曹雪芹写的红楼梦是中国古典小说中最著名的一部作品。"
    bench = [(1, "Who wrote Hamlet? William Shakespeare"), (2, "7 + 5 = 12"), (3, "Who wrote Hamlet? William Shakespeare"), (4, poem), (5, town), (6, "?!")]
    held = {
        1: (f"{prose(1, 40)} who wrote HAMLET?\nWilliam Shakespeare. {prose(2, 300)}", [1, 3]),
        2: (f"{prose(3, 500)}\n7 + 5 = 12", [2]),
        3: (f"William Shakespeare wrote it. Who wrote Hamlet? {prose(4, 40)} 5 + 7 = 12", []),
        4: (f"他们问{poem}然后走了", [4]),
        5: (f"这是开始{town}这是结束", [5]),
        6: ("曹雪芹写了谁", []),
        7: ("7 5", []),
        8: ("7 + 5 = 12", [2]),
    }
    docs = documents(spark, [(i, t, "en", "s") for i, (t, _) in held.items()])
    for own in (bench, [b for b in bench if b[0] != 5]):  # without a long item too
        benchmark = spark.createDataFrame(own, "item_id long, text string")
        want = sorted((i, k) for i, (_, found) in held.items() for k in found if k in dict(own))
        hits = decontamination.benchmark_hits(docs, benchmark).collect()
        assert sorted((r["id"], r["item"]) for r in hits) == want
        kept = decontamination.drop_contaminated(docs, benchmark).collect()
        assert {r["doc_id"] for r in kept} == set(held) - {i for i, _ in want}


def test_portions_find_the_same(spark, monkeypatch):
    bench = items(50)
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    docs = documents(spark, [(i, f"{prose(i, 80, 2000)} {t}", "en", "s") for i, t in bench])
    monkeypatch.setattr(decontamination, "PORTION_ITEMS", 20)
    assert sorted((r["id"], r["item"]) for r in decontamination.benchmark_hits(docs, benchmark).collect()) == [(i, i) for i in range(50)]
    assert decontamination.drop_contaminated(docs, benchmark).count() == 0


def test_defined_cases(spark, tricky, nothing):
    benchmark = spark.createDataFrame(items(5), "item_id long, text string")
    assert decontamination.drop_contaminated(tricky, benchmark).columns == tricky.columns
    assert decontamination.drop_contaminated(tricky, benchmark).count() == tricky.count()
    assert decontamination.benchmark_hits(nothing, benchmark).count() == 0
    assert decontamination.benchmark_hits(tricky, benchmark.limit(0)).count() == 0

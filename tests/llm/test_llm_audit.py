"""The filter audit against every order walked document by document."""

import itertools
import re
from collections import defaultdict

import cases
import numpy as np
import pytest

from sitelens.llm import filter_audit

SPACE = re.compile("[^\x20\x09-\x0d]+")


def fails(rows):
    """The verdicts of every row, with copies looked up over all of them."""
    out = []
    for i, t, *_ in rows:
        t = t or ""
        words = SPACE.findall(t)
        smaller = [j for j, u, *_ in rows if (u or "") == t and j is not None]
        out.append(
            {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                "D": bool(re.search("[#$%&*|]", t)),
                "E": i is not None and any(j < i for j in smaller),
            }
        )
    return out


def walked(rows, labels):
    found = {}
    judged = fails(rows)
    shapley = defaultdict(int)
    for order in map("".join, itertools.permutations("ABCDE")):
        left = list(range(len(rows)))
        for step, name in enumerate(order, start=1):
            gone = [k for k in left if judged[k][name]]
            left = [k for k in left if not judged[k][name]]
            for part in {r[2] or "" for r in rows}:
                own = lambda ks, part=part: [k for k in ks if (rows[k][2] or "") == part]
                removed = own(gone)
                failing = own(k for k in range(len(rows)) if judged[k][name])
                marked = lambda which: sum(labels.get(rows[k][0], (0, 0))[which] == 1 for k in removed)  # noqa: B023, E731
                shapley[part, name] += len(removed)
                found[part, order, step] = (
                    len(own(left)),
                    len(removed),
                    len(failing) - len(removed),
                    sum(sum(judged[k].values()) == 1 for k in failing),
                    marked(0),
                    marked(1),
                )
    return sorted((*key, *x, shapley[key[0], key[1][key[2] - 1]]) for key, x in found.items())


def audited(spark, rows, labels):
    docs = cases.frame(spark, rows)
    table = spark.createDataFrame(
        [(i, q, t, "x") for i, (q, t) in labels.items()] + [(None, 1, 1, "x")],
        "doc_id long, quality int, toxic int, fails string",
    )
    found = filter_audit.audit(filter_audit.tensors(filter_audit.verdicts(docs, table)))
    return sorted(map(tuple, found.collect()))


def test_audit_is_every_order_walked(ready):
    more = [
        (20, "WORD one " * 150, "en", "a"),
        (21, "WORD one " * 150, "de", "a"),
        (22, " ".join(f"w{i}" for i in range(250)), "en", "a"),
        (23, " ".join(f"w{i}" for i in range(250)), "", "a"),
        (19, " ".join(f"w{i}" for i in range(250)) + " #", "en", "a"),
        (18, "Ab " * 199, "en", "a"),
        (17, "ÄÖ é " * 100, "en", "a"),
        (None, "WORD one " * 150, "en", "a"),
    ]
    rows = cases.texts() + more
    labels = {1: (1, 0), 2: (0, 1), 12: (1, 1), 20: (None, 1), 22: (1, None), 23: (1, 1), 99: (1, 1)}
    assert audited(ready, rows, labels) == walked(rows, labels)


def test_hot_copies_and_no_documents(ready):
    rows = [(i, "hot text", ("en", "de")[i % 2], "a") for i in range(300)]
    assert audited(ready, rows, {}) == walked(rows, {})
    none = filter_audit.verdicts(cases.empty(ready), ready.createDataFrame(
        [], "doc_id long, quality int, toxic int"))
    assert filter_audit.audit(filter_audit.tensors(none)).collect() == []


def test_labels_of_an_id_count_once(ready):
    rows = ready.createDataFrame(
        [(1, 0, 1), (1, 1, None), (1, None, 0), (2, None, None)], "doc_id long, quality int, toxic int"
    )
    assert sorted(map(tuple, filter_audit.marks(rows).collect())) == [(1, 1, 1), (2, 0, 0)]


@pytest.mark.parametrize("seed", range(3))
def test_contractions_are_sums_over_cells(seed):
    tensor = np.random.default_rng(seed).integers(0, 9, (3, 2, 2, 2))
    for row in filter_audit.contractions(tensor, "ABC"):
        order = ["ABC".index(x) for x in row["filter_order"]]
        before, now = order[: row["step"] - 1], order[row["step"] - 1]
        cells = list(itertools.product((0, 1), repeat=3))
        removed = [c for c in cells if c[now] and not any(c[f] for f in before)]
        kept = [c for c in cells if not c[now] and not any(c[f] for f in before)]
        assert row["removed"] == sum(tensor[(0, *c)] for c in removed)
        assert row["good_lost"] == sum(tensor[(1, *c)] for c in removed)
        assert row["toxic_lost"] == sum(tensor[(2, *c)] for c in removed)
        assert row["kept"] == sum(tensor[(0, *c)] for c in kept)

import hashlib
from collections import defaultdict

from seasonmart.llm import exact_dedup as module
from seasonmart.llm.exact_dedup import exact_dedup
from tests.llm.conftest import ODD_ROWS


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids, default=None)
        yield i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_odd_rows(documents):
    assert rows_of(exact_dedup(documents(ODD_ROWS))) == sorted(expected(ODD_ROWS), key=str)
    assert exact_dedup(documents([])).collect() == []


def test_copies_over_partitions(documents, prose):
    rows = [(i, prose(5)) for i in range(400)]
    rows += [(1000 + i, "hot") for i in range(300)] + [(2000 + i, rows[i][1]) for i in range(50)]
    docs = documents(rows).repartition(7)
    assert rows_of(exact_dedup(docs)) == sorted(expected(rows), key=str)


def test_a_full_filter_only_costs_time(documents, prose, monkeypatch):
    monkeypatch.setattr(module, "filter_bits", lambda docs: 1 << 16)
    monkeypatch.setattr(module, "PROBES", 1)
    rows = [(i, prose(3)) for i in range(3000)] + [(5000, "a"), (5001, "a")]
    assert rows_of(exact_dedup(documents(rows))) == sorted(expected(rows), key=str)


def test_filter_size_is_bounded():
    assert module.filter_bits(0) == module.MIN_BITS
    assert module.filter_bits(10**12) == module.MAX_BITS

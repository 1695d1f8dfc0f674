"""Search through trigram postings gives the rows of the plain search."""

import os
import random

import pytest

from tally.operators import search_index
from tally.operators.filters import search
from tally.operators.search_index import SearchIndex
from tally.plans.service import LedgerService

NAMES = ["Saúde Ótima S.A.", "SAÚDE boa", "İstanbul Saude", "ab", "", None, "100% vida", "a_b\\c plano", "Unimed São", "unimed sao", "ΣΑΣ Clínica"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(8)
    rows = [(i, NAMES[i] if i < len(NAMES) else "Operadora " + "".join(rng.choices("abcdeé ", k=9)), f"{rng.randrange(10**14):014}", "SP") for i in range(600)]
    df = spark.createDataFrame(rows, "registro_ans long, razao_social string, cnpj string, uf string").repartition(3)
    return df, SearchIndex.build(df, str(tmp_path_factory.mktemp("idx")) + "/i", partitions=2, row_group_bytes=20_000)


TERMS = [None, "", "a", "ab", "saúde", "SAÚDE", "i̇st", "unimed", "Unimed S_o", "100%", "% vida", "a_b\\", "operadora", "zzzz", "σας", "sa%de", "dora a", "123", "8", "é d", "00_1", "a b c"]


@pytest.mark.parametrize("literal", [False, True])
def test_same_rows_for_every_term(table, literal):
    df, index = table
    some = random.Random(1).sample([r.cnpj[2:7] for r in df.collect()], 6)
    for term in TERMS + some:
        if not literal and term and term.endswith("\\"):
            continue  # no pattern at all, in either search
        key = lambda d: sorted(r.registro_ans for r in d.collect())
        assert key(index.search(df, term, literal=literal)) == key(search(df, term, literal=literal)), term


def test_scan_only_where_an_index_spares_nothing(table, monkeypatch):
    df, index = table
    assert index.candidates("ab") is None and index.candidates("operadora") is None and index.candidates("%") is None
    assert index.candidates("zzzz").count() == 0
    few = index.candidates("unimed")
    assert 2 <= few.count() < 60
    monkeypatch.setattr(search_index, "IN_LIST_MAX_KEYS", 1)
    assert sorted(r.registro_ans for r in index.search(df, "unimed").collect()) == [8, 9]


def test_served_listing_through_the_index(table):
    df, index = table
    plain, indexed = LedgerService(df, df), LedgerService(df, df, index)
    for term in ("unimed", "dora a", None, "zzz"):
        assert indexed.operators(1, 5, term) == plain.operators(1, 5, term)


def test_empty_table(table, tmp_path):
    df, _ = table
    index = SearchIndex.build(df.filter("1 = 0"), os.path.join(tmp_path, "i"))
    assert index.search(df.filter("1 = 0"), "unimed").count() == 0

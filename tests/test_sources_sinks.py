"""File round trips: delimited dialects, tolerant scan, ZIP archives, links,
sinks, partition pruning and the streaming ingest (SURVEY §5 items 3-5)."""

import io
import os
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tally.plans.consolidate import (MissingColumn, canonical_ledger, canonical_registry,
                                     consolidate)
from tally.sinks.tables import write_delimited, write_fact
from tally.sources import archives, delimited, links

D = Decimal


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def test_dialects_and_consolidation(spark, workdir):
    q1 = os.path.join(workdir, "2023_T1")
    q2 = os.path.join(workdir, "2023_T2")
    # (a) ';' latin-1 with accented, spaced headers; (f) a skipped revenue file
    write(f"{q1}/despesas.csv",
          "Registro ANS;CD_CONTA_CONTABIL;Razão Social;Vl. Saldo Final\n"
          "100001;411;Operadora Ação;1.234,56\n"
          "100001;4;X;1234.56\n"
          "100001;311;X;10,00\n"
          "100002;41;X;-5,00\n"
          "100002;41;X;abc\n"
          "100003;42;X;\n", "latin-1")
    write(f"{q1}/receitas.csv", "REG_ANS;VALOR\n1;99,00\n", "latin-1")
    # (b) ',' utf-8 with both value columns (D16: first alias wins)
    write(f"{q2}/sub/dados.CSV", "REG_ANS,VL_SALDO_FINAL,VALOR\n100004,\"8,00\",9\n100005,,3\n")
    groups = []
    for folder in (q1, q2):
        raw = delimited.read_group(spark, folder)
        raw = delimited.period_from_path(raw)
        groups.append(canonical_ledger(raw.drop("_source_path"), period_cols=("ano", "trimestre")))
    led = consolidate(groups).orderBy("Ano", "Trimestre", "ValorDespesas").collect()
    got = [(r["RegistroANS"], r["Ano"], r["Trimestre"], r["ValorDespesas"]) for r in led]
    # 'Registro ANS' normalises to REGISTRO_ANS; 'CNPJ'/'RazaoSocial' become 'N/A'
    assert got == [
        ("100001", 2023, 1, D("1234.56")),
        ("100001", 2023, 1, D("123456.00")),
        ("100005", 2023, 2, D("3.00")),
        ("100004", 2023, 2, D("8.00")),
    ]
    assert {r["CNPJ"] for r in led} == {"N/A"}


def test_value_column_gate(spark):
    df = spark.createDataFrame([("1", "x")], "REG_ANS string, OUTRA string")
    assert canonical_ledger(df, 2023, 1) is None
    with pytest.raises(MissingColumn):
        consolidate([None])
    with pytest.raises(MissingColumn):
        canonical_registry(spark.createDataFrame([("x",)], "NOME string"))


def test_registry_aliases(spark):
    df = spark.createDataFrame([(" 7 ", "1", "N", "M", "SP")],
                               "REGISTRO_OPERADORA string, CNPJ string, RAZAO_SOCIAL string, "
                               "MODALIDADE string, UF string")
    r = canonical_registry(df).first()
    assert (r["RegistroANS"], r["RazaoSocial"], r["UF"]) == (" 7 ", "N", "SP")


def test_tolerant_scan(spark, workdir):
    p = os.path.join(workdir, "cadop.csv")
    write(p, "REGISTRO_OPERADORA;CNPJ;UF\n1;111;SP\n2;222;RJ;EXTRA\n3;333\n4;NA;NULL\n", "latin-1")
    df = delimited.read_tolerant(spark, p, ["REGISTRO_OPERADORA", "CNPJ", "UF"])
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("1", "111", "SP"), ("3", "333", None), ("4", None, None)]


def test_staging_header_mismatch(spark, workdir):
    p = os.path.join(workdir, "staging.csv")
    write(p, "a;b\n1;2\n")
    ok = StructType([StructField("a", StringType()), StructField("b", StringType())])
    assert delimited.read_staging(spark, p, ok).count() == 1
    bad = StructType([StructField("b", StringType()), StructField("a", StringType())])
    with pytest.raises(Exception):
        delimited.read_staging(spark, p, bad).collect()


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, text in members.items():
            zf.writestr(name, text)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def test_zip_archives(spark, workdir):
    _zip(f"{workdir}/2023_T3/a.zip", {
        "x/1.csv": "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;2,50\n2;41;3,00\n",
        "2.csv": 'REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL;OBS\n3;41;4,00;"two\nlines; quoted"\n',
        "3.csv": "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL;OBS\n4;41;1,00\n",
        "ativo.csv": "REG_ANS;VL_SALDO_FINAL\n9;9,00\n",
        "leia-me.txt": "ignored",
    })
    with open(f"{workdir}/2023_T3/broken.zip", "wb") as f:
        f.write(b"not a zip")
    records = archives.archive_records(spark, workdir)
    errs = archives.archive_errors(records).collect()
    assert len(errs) == 1 and errs[0]["archive"].endswith("broken.zip")
    frames = archives.parse_members(records)
    assert len(frames) == 2  # two header layouts
    obs = [r["OBS"] for f in frames if "OBS" in f.columns for r in f.collect()]
    assert sorted(o for o in obs if o) == ["two\nlines; quoted"] and None in obs
    shaped = [canonical_ledger(delimited.period_from_path(f).drop("_source_path"),
                               period_cols=("ano", "trimestre")) for f in frames]
    got = sorted((r["RegistroANS"], r["Trimestre"], r["ValorDespesas"])
                 for r in consolidate(shaped).collect())
    assert got == [("1", 3, D("2.50")), ("2", 3, D("3.00")), ("3", 3, D("4.00")),
                   ("4", 3, D("1.00"))]


def _xlsx(path, rows):
    """A minimal workbook: shared strings for text, plain values for numbers."""
    shared, sheet_rows = [], []
    for r, row in enumerate(rows, start=1):
        cells = []
        for c, v in enumerate(row):
            ref = f"{chr(65 + c)}{r}"
            if v is None:
                continue
            if isinstance(v, str):
                shared.append(v)
                cells.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
            else:
                cells.append(f'<c r="{ref}"><v>{v}</v></c>')
        sheet_rows.append(f'<row r="{r}">{"".join(cells)}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
                           f'<sheet name="Dados" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{pkg}"><Relationship Id="rId1" '
                                      f'Target="worksheets/sheet1.xml" Type="x"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{main}">'
                                + "".join(f"<si><t>{t}</t></si>" for t in shared) + "</sst>",
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>'
                                    + "".join(sheet_rows) + "</sheetData></worksheet>",
    }
    _zip(path, parts)


def test_spreadsheets(spark, workdir):
    _xlsx(f"{workdir}/2024_T1/despesas.xlsx", [
        ["REG_ANS", "CD_CONTA_CONTABIL", "VL_SALDO_FINAL", "OBS"],
        ["1", "41", "1.234,56", None],
        [2, 41, 7.5, "x"],          # numeric cells keep their stored text
    ])
    _xlsx(f"{workdir}/2024_T1/ativo.xlsx", [["REG_ANS", "VL_SALDO_FINAL"], ["9", "9,00"]])
    with open(f"{workdir}/2024_T1/broken.xlsx", "wb") as f:
        f.write(b"nope")
    records = archives.read_spreadsheets(spark, workdir)
    assert len(archives.archive_errors(records).collect()) == 1
    frames = archives.parse_members(records)
    shaped = [canonical_ledger(delimited.period_from_path(f).drop("_source_path"),
                               period_cols=("ano", "trimestre")) for f in frames]
    got = sorted((r["RegistroANS"], r["Trimestre"], r["ValorDespesas"])
                 for r in consolidate(shaped).collect())
    # '7.5' read as pt-BR text: the '.' is a thousands mark -> 75
    assert got == [("1", 1, D("1234.56")), ("2", 1, D("75.00"))]


def test_links(spark):
    html = ('<html><a href="../">up</a><a href="?C=N">sort</a><a href="2023/">y</a>'
            '<a class="x" href="1T2023.zip">q</a><a href="/Demonstracoes_Contabeis/">d</a>'
            '<a href="">e</a><a href="http://other/x?a=1&amp;b=2">o</a><link href="/css"></html>')
    pages = spark.createDataFrame([(1, "https://h.example:8080/FTP/PDA/", html)],
                                  "page_id bigint, url string, html string")
    ls = links.extract_links(pages).orderBy("pos").collect()
    assert [(r["pos"], r["href"]) for r in ls] == [
        (2, "2023/"), (3, "1T2023.zip"), (4, "/Demonstracoes_Contabeis/"),
        (6, "http://other/x?a=1&b=2")]
    res = links.resolve_links(links.extract_links(pages), out="u").orderBy("pos").collect()
    assert [r["u"] for r in res] == [
        "https://h.example:8080/FTP/PDA/2023/", "https://h.example:8080/FTP/PDA/1T2023.zip",
        "https://h.example:8080/Demonstracoes_Contabeis/", "http://other/x?a=1&b=2"]
    native = links.extract_links(pages).select(
        links.resolve_native("url", "href").alias("u")).collect()
    assert sum(r["u"] is None for r in native) == 0  # every shape here resolves natively
    arr = links.link_array(F.col("html"))
    pick = pages.select(links.pick_link(arr, ["demonstracoes", "contabeis"], "all").alias("p"),
                        links.pick_link(arr, ["nothing"], "any", "fallback").alias("f")).first()
    assert pick["p"] == "/Demonstracoes_Contabeis/" and pick["f"] == "fallback"
    files = spark.createDataFrame([(["ativa/", "relatorio.pdf", "x.csv", "Relatorio_Cadop.CSV"],)], "a array<string>")
    assert files.select(links.pick_link(F.col("a"), ["relatorio", "cadop"], "any", suffix=".csv")).first()[0] == "Relatorio_Cadop.CSV"


def test_archive_links(spark):
    html = '<a href="../">up</a><a href="Dados_1T2023.ZIP">z</a><a href="leia-me.txt">t</a>' \
           '<a href="/outro/2T2023.zip">y</a>'
    pages = spark.createDataFrame(
        [(1, "https://h/FTP/2023/1T2023/", html), (2, "https://h/FTP/3T2023.zip", "")],
        "page_id bigint, url string, html string")
    got = sorted(r["archive_url"] for r in links.archive_links(pages).collect())
    assert got == ["https://h/FTP/2023/1T2023/Dados_1T2023.ZIP", "https://h/FTP/3T2023.zip",
                   "https://h/outro/2T2023.zip"]


def test_latest_periods_dedupe_quarters(spark):
    df = spark.createDataFrame([("1T2023.zip",), ("1t2023_parte2.zip",), ("4T2022.zip",),
                                ("3T2022.zip",), ("2T2022.zip",), ("leia-me.txt",)], "link string")
    got = [tuple(r) for r in links.latest_periods(links.with_period(df, "link"), 3).collect()]
    assert got == [(2023, 1), (2022, 4), (2022, 3)]


def test_csv_sink_round_trip(spark, workdir):
    df = spark.createDataFrame([("1", D("1234.50"), 0.5)], "k string, v decimal(15,2), s double")
    out = os.path.join(workdir, "mart_csv")
    write_delimited(df, out, compression="gzip")
    assert any(n.endswith(".gz") for n in os.listdir(out))
    back = spark.read.option("sep", ";").option("header", "true").csv(out).first()
    assert (back["k"], back["v"], back["s"]) == ("1", "1234.50", "0.50")


def test_partitioned_fact_pruning_and_idempotent_reload(spark, workdir):
    rows = [(k, 2023, t, D("1.00")) for k in range(20) for t in (1, 2, 3)]
    fact = spark.createDataFrame(rows, "registro_ans bigint, ano int, trimestre int, valor_despesa decimal(15,2)")
    path = os.path.join(workdir, "fact")
    write_fact(fact, path, partitions=4)
    write_fact(fact.filter("trimestre = 3"), path, partitions=4, dynamic=True)
    back = spark.read.parquet(path)
    assert back.count() == 60  # dynamic overwrite replaced Q3 only, no duplicates
    periods = spark.createDataFrame([(2023, 2)], "ano int, trimestre int")
    pruned = links.prune_to_periods(back, periods)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and pruned.count() == 20


def test_streaming_ingest(spark, workdir):
    from tally.streaming.ingest import start_ingest

    landing = os.path.join(workdir, "landing")
    write(f"{landing}/2024_T1/a.csv", "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;1,00\n2;31;5,00\n")
    write(f"{landing}/2024_T2/b.csv", "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;2,00\n")
    target = os.path.join(workdir, "ledger")
    cols = ["REG_ANS", "CD_CONTA_CONTABIL", "VL_SALDO_FINAL"]
    q = start_ingest(spark, landing, target, cols, name="t_ingest", sep=";", encoding="UTF-8")
    q.awaitTermination(120)
    got = sorted((r["RegistroANS"], r["Trimestre"], r["ValorDespesas"])
                 for r in spark.read.parquet(target).collect())
    assert got == [("1", 1, D("1.00")), ("1", 2, D("2.00"))]
    # restart on the same checkpoint: already-seen files are not ingested again,
    # a new file is
    write(f"{landing}/2024_T2/c.csv", "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n3;41;4,00\n")
    q = start_ingest(spark, landing, target, cols, name="t_ingest", sep=";", encoding="UTF-8")
    q.awaitTermination(120)
    got = sorted((r["RegistroANS"], r["Trimestre"], r["ValorDespesas"])
                 for r in spark.read.parquet(target).collect())
    assert got == [("1", 1, D("1.00")), ("1", 2, D("2.00")), ("3", 2, D("4.00"))]


def test_build_warehouse_end_to_end(spark, workdir):
    from tally.plans.batch import build_warehouse

    write(f"{workdir}/raw/2023_T1/d.csv",
          "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;1.000,00\n2;41;5,00\n7;41;3,00\n", "latin-1")
    _zip(f"{workdir}/raw/2023_T2/d.zip",
         {"d.csv": "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;500,00\n"})
    # a registry with more columns than used, in its own order, latin-1 text
    write(f"{workdir}/cadop.csv",
          "Registro_ANS;CNPJ;Razao_Social;Nome_Fantasia;Modalidade;Cidade;UF\n"
          "1;11.222.333/0001-81;Alfa;A;M;São Paulo;SP\n2;11222333000182;Beta;B;M;Rio;N/A\n"
          "ABC;x;Bad;C;M;Recife;RJ\n", "latin-1")
    wh = build_warehouse(spark, [f"{workdir}/raw"], f"{workdir}/cadop.csv", out=f"{workdir}/wh")
    assert wh.ledger.count() == 4
    assert wh.quarantined.count() == 1           # key without digits (D13)
    facts = sorted((r["registro_ans"], r["trimestre"], r["valor_despesa"]) for r in wh.fact.collect())
    assert facts == [(1, 1, D("1000.00")), (1, 2, D("500.00")), (2, 1, D("5.00"))]  # 7 unknown
    dims = {r["registro_ans"]: r["uf"] for r in wh.dimension.collect()}
    assert dims == {1: "SP", 2: None}            # 'N/A' state -> NULL (D5)
    marts = {r["RegistroANS"]: r["RazaoSocial"] for r in wh.mart.collect()}
    assert marts["7"] == "Operadora 7 Desconhecida"
    from tally.plans.serving import expense_history, operator_detail
    det = operator_detail(wh.dimension, "11.222.333/0001-81")
    assert "EqualTo(cnpj_digits,11222333000181)" in det._jdf.queryExecution().executedPlan().toString()
    assert [r["valor_despesa"] for r in expense_history(wh.fact, wh.dimension, "11222333000181").collect()] == [500.0, 1000.0]
    audit = {r["RegistroANS"]: r["qtd_registros"] for r in wh.cnpj_audit.collect()}
    assert audit == {"2": 1, "7": 1}             # wrong check digit; unknown operator ('N/A')
    exported = spark.read.option("sep", ";").option("header", "true").csv(f"{workdir}/wh/mart_csv")
    assert {r["DesvioPadrao"] for r in exported.collect()} >= {"0.00"}
    orphan = wh.orphan_audit.first()
    assert orphan["orphan_rows"] == 1 and orphan["orphan_value"] == D("3.00")
    # the export itself is in rank order (T1); one file at this size
    text = spark.read.option("sep", ";").option("header", "true").csv(f"{workdir}/wh/mart_csv")
    assert [r["RegistroANS"] for r in text.collect()] == ["1", "2", "7"]
    # the typed mart is served under its own column names
    from tally.plans.service import register_views
    register_views(spark, wh.dimension, wh.fact, wh.mart_table)
    top = spark.sql("SELECT registro_ans, valor_total, media_trimestral, desvio_padrao "
                    "FROM despesas_agregadas_final ORDER BY valor_total DESC LIMIT 1").first()
    assert tuple(top) == (1, D("1500.00"), D("750.00"), D("353.55"))


def test_no_amount_or_archive_is_lost_silently(spark, workdir):
    from tally.plans.batch import build_warehouse

    write(f"{workdir}/raw/2023_T1/d.csv",
          "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;1.000,00\n2;41;99999999999999,00\n"
          "3;41;-99999999999999,00\n4;41;abc\n")
    _zip(f"{workdir}/raw/2023_T1/good.zip",
         {"d.csv": "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;500,00\n"})
    with open(f"{workdir}/raw/2023_T1/bad.zip", "wb") as f:
        f.write(b"no archive")
    write(f"{workdir}/cadop.csv", "REGISTRO_OPERADORA;CNPJ;RAZAO_SOCIAL;MODALIDADE;UF\n1;x;A;M;SP\n")
    wh = build_warehouse(spark, [f"{workdir}/raw"], f"{workdir}/cadop.csv", out=f"{workdir}/wh")
    assert sorted(r["ValorDespesas"] for r in wh.ledger.collect()) == [D("500.00"), D("1000.00")]
    assert [tuple(r) for r in wh.rejected_amounts.collect()] == [("2", 2023, 1, "99999999999999,00")]
    assert [r["archive"].rsplit("/", 1)[1] for r in wh.archive_errors.collect()] == ["bad.zip"]


def test_latest_quarters_open_only_their_folders(spark, workdir):
    from tally.plans.batch import build_warehouse

    for t in (1, 2, 3):
        _zip(f"{workdir}/raw/2023_T{t} [a]/d.zip",
             {"d.csv": f"REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;{t},00\n"})
    write(f"{workdir}/cadop.csv", "REGISTRO_OPERADORA;CNPJ;RAZAO_SOCIAL;MODALIDADE;UF\n1;x;A;M;SP\n")
    wh = build_warehouse(spark, [f"{workdir}/raw"], f"{workdir}/cadop.csv", out=f"{workdir}/wh",
                         formats=("zip",), latest_quarters=2)
    assert sorted(r["Trimestre"] for r in wh.ledger.collect()) == [2, 3]
    records = spark.read.parquet(f"{workdir}/wh/staging/records_0_zip")
    assert records.select("archive").distinct().count() == 2  # the first quarter was never expanded


def test_stream_batch_without_value_column(spark, workdir):
    from tally.streaming.ingest import start_ingest

    write(f"{workdir}/landing/2023_T1/a.csv", "REG_ANS;CD_CONTA_CONTABIL;OUTRA\n1;41;9,00\n")
    q = start_ingest(spark, f"{workdir}/landing", f"{workdir}/target",
                     ["REG_ANS", "CD_CONTA_CONTABIL", "OUTRA"], name="no_value")
    q.awaitTermination(60)
    assert q.exception() is None


def test_latest_quarters_only(spark, workdir):
    from tally.plans.batch import build_warehouse

    for y, t, v in ((2022, 4, "1,00"), (2023, 1, "2,00"), (2023, 2, "3,00"), (2023, 3, "4,00")):
        write(f"{workdir}/raw/{y}_T{t}/d.csv", f"REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;{v}\n")
    # the same quarter in a second file counts once in the selection
    write(f"{workdir}/raw/2023_T3/e.csv", "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;5,00\n")
    write(f"{workdir}/cadop.csv", "REGISTRO_OPERADORA;CNPJ;RAZAO_SOCIAL;MODALIDADE;UF\n1;x;A;M;SP\n")
    wh = build_warehouse(spark, [f"{workdir}/raw"], f"{workdir}/cadop.csv", out=f"{workdir}/wh",
                         formats=("csv",), latest_quarters=3)
    got = sorted((r["Ano"], r["Trimestre"], r["ValorDespesas"]) for r in wh.ledger.collect())
    assert got == [(2023, 1, D("2.00")), (2023, 2, D("3.00")), (2023, 3, D("4.00")),
                   (2023, 3, D("5.00"))]


def test_command_line(spark, workdir, capsys):
    from tally.__main__ import main

    write(f"{workdir}/raw/2023_T1/d.csv", "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;10,00\n", "latin-1")
    write(f"{workdir}/raw/2023_T2/d.csv", "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;15,00\n", "latin-1")
    write(f"{workdir}/cadop.csv", "REGISTRO_OPERADORA;CNPJ;RAZAO_SOCIAL;MODALIDADE;UF\n"
          "1;11.222.333/0001-81;Alfa;M;SP\n", "latin-1")
    main(["warehouse", f"{workdir}/raw", f"{workdir}/cadop.csv", f"{workdir}/wh"])
    main(["stats", f"{workdir}/wh"])
    out = capsys.readouterr().out.strip().splitlines()
    assert '"ledger_rows": 2' in out[0]
    assert '"total_despesas": 25.0' in out[-1]


def test_resolution_matches_urljoin(spark):
    import itertools
    from urllib.parse import urljoin

    bases = ["https://h.example:8080/FTP/PDA/x.html?q=1#f", "HTTP://u:p@h/a/b/", "http://h",
             "https://h/a/./b?x#y", "https://h/a?#y", "https://h/a#y", "https://h/a;p/b"]
    hrefs = ["/a/../b", "/a/./b", "/a/b/", "http://x/./y", "HTTP://x/y", "//x/./y", "//x/y?",
             "/a?b#c", "/.", "/..", "mailto:x", "https:foo", "/a?", "/a#", "/a?#x", "/a;p?x",
             "/a/.hidden", "/a/..b", "2023/", "../up", "?C=N", "#top", "x.zip", "./y", "/a//b",
             "/%41", "https://x/y#", "ftp://x/y", "a/b/../../../c", "a//b/./c/", "..", ".",
             "../../..", "x/..", "x/.", "2023/1T2023.zip?dl=1#k", "/a/b/../../../c", "a;p",
             "", "?q", "#f", "x:y", "2023:x", "%2F", "a/b?c/../d", "./../x", "?q#f", "?", "#",
             "?#f", "#f#g", "??q"]
    pairs = list(itertools.product(bases, hrefs))
    df = spark.createDataFrame(pairs, "url string, href string")
    got = {(r["url"], r["href"]): r["u"] for r in links.resolve_links(df, out="u").collect()}
    assert got == {(b, h): urljoin(b, h) for b, h in pairs}


def test_random_relative_paths_match_urljoin(spark):
    import random
    from urllib.parse import urljoin

    rnd = random.Random(11)
    parts = ["a", "b", ".", "..", "", "x.zip", "2023", "%20"]
    bases = ["https://h/", "https://h/d1/d2/f.html", "https://h/d1/d2/", "http://h",
             "https://u@h:1/d/./e/../f?q#z"]
    pairs = []
    for _ in range(600):
        segs = [rnd.choice(parts) for _ in range(rnd.randrange(1, 6))]
        href = "/".join(segs)
        if rnd.random() < 0.3:
            href = "/" + href
        if rnd.random() < 0.2:
            href += "?k=v"
        if rnd.random() < 0.2:
            href += "#frag"
        pairs.append((rnd.choice(bases), href))
    df = spark.createDataFrame(pairs, "url string, href string")
    got = [(r["url"], r["href"], r["u"]) for r in links.resolve_links(df, out="u").collect()]
    bad = [(b, h, u, urljoin(b, h)) for b, h, u in got if u != urljoin(b, h)]
    assert bad == []


def test_streaming_archive_ingest(spark, workdir):
    from tally.streaming.ingest import start_archive_ingest

    landing = os.path.join(workdir, "zips")
    _zip(f"{landing}/2024_T3/a.zip", {"a.csv": "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n1;41;1,50\n"})
    _zip(f"{landing}/2024_T4/b.zip", {"b.csv": "REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_FINAL\n2;41;2,50\n3;31;9,00\n"})
    target = os.path.join(workdir, "ledger_zip")
    q = start_archive_ingest(spark, landing, target, name="t_zip_ingest")
    q.awaitTermination(180)
    got = sorted((r["RegistroANS"], r["Trimestre"], r["ValorDespesas"])
                 for r in spark.read.parquet(target).collect())
    assert got == [("1", 3, D("1.50")), ("2", 4, D("2.50"))]


def test_defaults_and_literal_period(spark):
    raw = spark.createDataFrame([("41", "3,00", "x")], "CD_CONTA_CONTABIL string, VALOR string, OUTRA string")
    led = consolidate([canonical_ledger(raw, ano=2022, trimestre=4)]).first()
    # no key column -> '0' (H4); names are placeholders; period from the arguments (H5)
    assert (led["RegistroANS"], led["CNPJ"], led["RazaoSocial"], led["Ano"], led["Trimestre"],
            led["ValorDespesas"]) == ("0", "N/A", "N/A", 2022, 4, D("3.00"))
    # no account column: the expense-account filter is not applied (F1)
    raw2 = spark.createDataFrame([("7", "5,00")], "REG_ANS string, VL_SALDO_FINAL string")
    assert consolidate([canonical_ledger(raw2, 2022, 4)]).count() == 1

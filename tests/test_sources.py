import os
import tempfile

from pyspark.sql import functions as F

from fieldops.sources import io
from fieldops.sources.keyed import KeyedTable
from fieldops.sources.sites import build_sites, pick_feeds


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_landing_scan_arrival_and_provenance(spark):
    d = tempfile.mkdtemp(prefix="fieldops-landing-")
    _write(f"{d}/3.9.tickets.csv", "Task Id,v\nT1,a\nT2,b\n")
    _write(f"{d}/1.2.tickets.csv", "Task Id,v\nT1,c\n")
    _write(f"{d}/base.csv", "Task Id,v\nT1,z\nT3,y\n")
    _write(f"{d}/old_procesado_20250101.csv", "Task Id,v\nT1,old\n")
    df = io.read_landing(spark, d, glob="*.csv")
    assert sorted(r[0] for r in df.select(io.FILE_NAME).distinct().collect()) == [
        "1.2.tickets.csv", "3.9.tickets.csv", "base.csv"]
    ranked = io.with_arrival_order(df)
    order = [r[0] for r in ranked.select(io.FILE_NAME, "_arrival").distinct().orderBy("_arrival").collect()]
    # undated first; 3 September (2024) before 1 February (2025)
    assert order == ["base.csv", "3.9.tickets.csv", "1.2.tickets.csv"]
    from fieldops.functions.clean import normalize_names
    from fieldops.operators.state import latest_by_key
    latest = latest_by_key(normalize_names(ranked), "Task_Id", ["_arrival"]).orderBy("Task_Id")
    assert [(r.Task_Id, r.v) for r in latest.collect()] == [("T1", "c"), ("T2", "b"), ("T3", "y")]


def test_contract_check_and_banner_feed(spark):
    d = tempfile.mkdtemp(prefix="fieldops-contract-")
    _write(f"{d}/good.csv", "Task Id,Nro TOA\n1,2\n")
    _write(f"{d}/bad.csv", "Task Id,x\n1,2\n")
    ok, rep = io.validate_contract(spark, [f"{d}/good.csv", f"{d}/bad.csv"], ["Task Id", "Nro TOA"])
    assert [os.path.basename(p) for p in ok] == ["good.csv"]
    assert [tuple(r) for r in rep.collect()] == [("bad.csv", "Nro TOA", "")]
    _, rep = io.validate_contract(spark, [f"{d}/good.csv", f"{d}/bad.csv"], ["Task Id"], known=["Nro TOA"])
    assert [tuple(r) for r in rep.collect()] == [("bad.csv", "", "x")]  # accepted, but no contract knows x
    _write(f"{d}/inc1.txt", "Reporte\nGenerado hoy\nID,Estado\nINC1,Abierto\nINC2,\"Cerrado, ok\"\n\n")
    _write(f"{d}/inc2.txt", "Reporte\r\nGenerado\r\nID,Estado\r\nINC3,Abierto\r\nINC4,\"a\nb\"\"c\"\r\n")
    df = io.read_with_banner(spark, f"{d}/inc*.txt", ["ID_incidencia", "Estado"])
    assert sorted((r.ID_incidencia, r.Estado) for r in df.collect()) == [
        ("INC1", "Abierto"), ("INC2", "Cerrado, ok"), ("INC3", "Abierto"), ("INC4", 'a\nb"c')]


def test_versioned_table_extracts_and_inventory(spark):
    d = tempfile.mkdtemp(prefix="fieldops-tables-")
    v1 = spark.createDataFrame([(1, "a")], "k int, v string")
    io.write_table(v1, d, "t", "0001")
    cur = io.read_table(spark, d, "t")
    io.write_table(cur.withColumn("v", F.lit("b")), d, "t", "0002")  # replace while reading the old version
    assert [tuple(r) for r in io.read_table(spark, d, "t").collect()] == [(1, "b")]
    rows = spark.createDataFrame([(1, "Bucket COMFICA"), (2, "huawei y comfica"), (3, "otro")], "id int, b string")
    ext = io.vendor_rows(rows, "b", ["comfica", "huawei"])
    assert sorted((r.id, r.vendor) for r in ext.collect()) == [(1, "comfica"), (2, "comfica"), (2, "huawei")]
    io.write_vendor_extracts(ext, f"{d}/extracts")
    assert sorted(os.listdir(f"{d}/extracts"))[-2:] == ["vendor=comfica", "vendor=huawei"]
    from conftest import SF_SMALL
    assert io.export_catalog(spark, SF_SMALL, f"{d}/export", ["region", "nation"]) == ["region", "nation"]
    counts = {r.table_name: r.n_rows for r in io.table_counts(spark, f"{d}/export", ["region", "nation"]).collect()}
    assert counts == {"region": 5, "nation": 25}


def test_site_feeds(spark):
    assert pick_feeds(["/x/Base_Sitios.xlsx", "/x/casos SWAP.csv", "/x/TSS.csv"])["tss"] == "/x/TSS.csv"
    try:
        pick_feeds(["/x/Base_Sitios.xlsx"])
        raise AssertionError("missing feeds must stop the build")
    except ValueError:
        pass
    base = spark.createDataFrame([("S1", "Lima"), ("S2", "Puno")], "Codigo_Unico string, Departamento string")
    swap = spark.createDataFrame([("S1", "2024-01-01", 3)], "Codigo_Unico string, Fecha_Fin_Swap string, Alarmas int")
    tss = spark.createDataFrame([("S2_Swap", "2024-02-01", 9)], "Codigo_Unico string, Fecha_TSS string, Alarmas int")
    out = build_sites(base, swap, tss).orderBy("Codigo_Unico")
    assert out.columns == ["Codigo_Unico", "Departamento", "Fecha_Fin_Swap", "Alarmas", "Fecha_TSS", "Alarmas_tss"]
    assert [tuple(r) for r in out.collect()] == [("S1", "Lima", "2024-01-01", 3, None, None),
                                                 ("S2", "Puno", None, None, "2024-02-01", 9)]


def test_batch_ingest_upserts_by_arrival(spark):
    from fieldops.operators.state import order_out
    from fieldops.plans.ingest import ingest
    d = tempfile.mkdtemp(prefix="fieldops-ingest-")
    land, root = f"{d}/landing", f"{d}/tables"
    os.makedirs(land)
    _write(f"{land}/10.8.toa.csv", "Nro TOA,Estado,Monto,Mes\n1,Pendiente,2.5,8\n2,Pendiente,1,8\n")
    _write(f"{land}/base.csv", "Nro TOA,Estado,Monto,Mes\n1,Viejo,9,1\n")
    _write(f"{land}/bad.csv", "Otra,Estado\n1,x\n")
    contract = {"Nro_TOA": "INTEGER", "Estado": "TEXT", "Monto": "REAL"}
    files = [f"{land}/{f}" for f in sorted(os.listdir(land))]
    t1, rep = ingest(spark, files, "Nro_TOA", contract, root, "toa", "0001", required=["Nro TOA"])
    assert [tuple(r) for r in rep.collect()] == [("bad.csv", "Nro TOA", "Otra")]
    assert [tuple(r) for r in order_out(t1.select("Nro_TOA", "Estado", "Monto"), ["Nro_TOA"]).collect()] == [
        (1, "Pendiente", 2.5), (2, "Pendiente", 1.0)]
    _write(f"{land}/2.1.toa.csv", "Estado,Nro TOA,Monto\nCompletado,2,3\n")  # other column order
    t2, _ = ingest(spark, [f"{land}/2.1.toa.csv"], "Nro_TOA", contract, root, "toa", "0002", required=["Nro TOA"])
    assert [tuple(r) for r in order_out(t2.select("Nro_TOA", "Estado"), ["Nro_TOA"], [True]).collect()] == [
        (2, "Completado"), (1, "Pendiente")]


def test_batch_ingest_rules(spark):
    """Old-status marker removed (C9), composite key (C12), last row of a drop wins,
    quoted line breaks kept, renames and projection applied, the drop recorded (S12)."""
    from fieldops import config
    from fieldops.plans.ingest import ingest
    d = tempfile.mkdtemp(prefix="fieldops-rules-")
    os.makedirs(f"{d}/1.9.x")
    _write(f"{d}/1.9.x/a.csv", 'Order ID,Operation Time,Estado,Nro TOA,Nota\n7,t1,"Pendiente (antiguo)",5,"uno\ndos"\n7,t1,Suspendido,6,"a ""b"""\n7,t2,Pendiente (antiguo),8,\n')
    contract = {"Order_ID": "TEXT", "Operation_Time": "TEXT", "Estado": "TEXT", "Number_OS_SIOM": "INTEGER", "Nota": "TEXT"}
    out, rep = ingest(spark, [f"{d}/1.9.x/a.csv"], "Index", contract, f"{d}/t", "pausas", "0", required=config.PAUSE_REQUIRED,
                      rename=config.TASK_RENAMES, strip_marker=["Estado"], make_key=["Order_ID", "Operation_Time"], source_col="origen")
    assert rep.isEmpty()
    got = sorted(tuple(r) for r in out.select("Index", "Estado", "Number_OS_SIOM", "Nota", "origen").collect())
    assert got == [("7_t1", "Suspendido", 6, 'a "b"', "1.9.x"), ("7_t2", "Pendiente", 8, None, "1.9.x")]


def test_incident_state_judges_the_latest_row(spark):
    from fieldops.plans.ingest import incident_state
    d = tempfile.mkdtemp(prefix="fieldops-inc-")
    head = "x\ny\nh1,h2,h3,h4,h5,h6,h7,h8,h9,h10\n"
    row = lambda i, date, group: f'{i},E,{date},,2024-09-05 10:00:00,,T,R,"n\nm",{group}\n'
    _write(f"{d}/a.txt", head + row("I1", "05/09/2024 10:00:00", "FLM COMFICA") + row("I2", "31/12/2024 09:05", "FLM HUAWEI x") + row("I4", "", ""))
    _write(f"{d}/b.txt", head + row("I1", "06/09/2024 10:00:00", "NOC") + row("I3", "nada", "flm huawei") + row("I3", "2024-02-03 01:02:03", "FLM HUAWEI"))
    out = incident_state(spark, f"{d}/*.txt", f"{d}/t", "inc", "0")
    got = sorted(tuple(r) for r in out.select("ID_incidencia", "Fecha_envio", "Fecha_inicio_incidente", "Notas").collect())
    assert got == [("I2", "2024-12-31 09:05:00", "2024-09-05 10:00:00", "n\nm"), ("I3", "2024-02-03 01:02:03", "2024-09-05 10:00:00", "n\nm")]
    _write(f"{d}/c.txt", head + row("I2", "", "NOC"))
    out = incident_state(spark, f"{d}/c.txt", f"{d}/t", "inc", "1")
    assert [r.ID_incidencia for r in out.collect()] == ["I3"]


def test_counts_come_from_footers(spark, tmp_path):
    root = f"file:{tmp_path}"
    io.write_table(spark.range(50).repartition(3), root, "full", "0")
    KeyedTable.create(spark.range(70), root, "keyed", ["id"], "pmod(id, 4)").publish()
    for df, want in ((io.inventory(spark, root), {"full": 50, "keyed": 70}), (io.table_counts(spark, "/root/testdata/sf0.001", ["orders", "labels"]), None)):
        got = {r.table_name: r.n_rows for r in df.collect()}
        assert want is None and got["orders"] == 1500 or got == want
        plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
        assert plan.count("PushedAggregation: [COUNT(*)]") == plan.count("Location:") == len(got)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")

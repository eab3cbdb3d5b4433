"""Run the driver contract the way an outside harness would: a plain session
(default settings), entry() on sf0.001, then every query at sf0.01 collected and
compared with its SQL twin in DuckDB.
usage: python tools/simulate_driver.py [SF_DIR] [--ansi-off]"""
import sys, time, os
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.chdir(ROOT)
from pyspark.sql import SparkSession
ANSI_OFF = "--ansi-off" in sys.argv
ARGS = [a for a in sys.argv[1:] if not a.startswith("--")]
builder = SparkSession.builder.master("local[8]").appName("sim")
if ANSI_OFF:
    builder = builder.config("spark.sql.ansi.enabled", "false")
spark = builder.getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", os.path.join(ROOT, "__spark_entry__.py"))
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
t = time.time(); rows = E.entry(spark).collect(); print("entry rows", len(rows), round(time.time()-t, 1))
import duckdb
con = duckdb.connect()
sf = ARGS[0] if ARGS else "/root/testdata/sf0.01"
for f in os.listdir(sf):
    con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf}/{f}')")
qs, sql = E.queries(), E.oracle_sql()
def norm(v):
    if isinstance(v, float): return round(v, 9)
    return v
bad = 0; total = time.time()
for n in sorted(qs):
    t = time.time()
    df = qs[n](spark, sf); r = df.collect(); cols = df.columns
    dt = time.time() - t
    if n in sql:
        cur = con.execute(sql[n]); d = cur.fetchall(); dc = [x[0] for x in cur.description]
        o1 = sorted(range(len(cols)), key=lambda i: cols[i]); o2 = sorted(range(len(dc)), key=lambda i: dc[i])
        a = sorted((tuple(norm(x[i]) for i in o1) for x in r), key=repr)
        b = sorted((tuple(norm(x[i]) for i in o2) for x in d), key=repr)
        ok = a == b and sorted(cols) == sorted(dc)
        bad += not ok
        print(("ok  " if ok else "BAD ") + n, len(r), round(dt, 1))
    else:
        print("rows", n, len(r), round(dt, 1))
print("bad", bad, "total", round(time.time() - total, 1), "tz", spark.conf.get("spark.sql.session.timeZone"), "parts", spark.conf.get("spark.sql.shuffle.partitions"))

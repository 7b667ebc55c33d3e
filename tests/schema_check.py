"""Compare column types of every query with its DuckDB oracle (sf0.001)."""
import sys, os
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))); sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from learnscope.session import local_session
import __spark_entry__ as E
from oracle_check import duck
spark = local_session()
sf = "/root/testdata/sf0.001"
con = duck(sf)
M = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT",
     "smallint": "SMALLINT", "tinyint": "TINYINT", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}
qs, os_ = E.queries(), E.oracle_sql()
for k in os_:
    s = {f.name: M.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in qs[k](spark, sf).schema.fields}
    cur = con.execute(f"DESCRIBE {os_[k]}").fetchall()
    o = {r[0]: r[1] for r in cur}
    bad = {c: (s.get(c), o.get(c)) for c in set(s) | set(o) if s.get(c) != o.get(c)}
    if bad:
        print(k, bad)
print("done")

"""Run registered queries against their SQL: check.py <folder> [name ...]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tests import oracle  # noqa: E402
from txlake.plans import load_queries  # noqa: E402
from txlake.session import build_session  # noqa: E402


FAMILY = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("check", f"local[{os.environ.get('BENCH_CPUS', '8')}]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(folder)
    bad = 0
    for name, q in load_queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t0 = time.time()
        try:
            df = q.run(spark, folder)
            names, got = oracle.spark_rows(df)
        except Exception as e:  # noqa: BLE001 - report and go on
            bad += 1
            print(f"ERROR {name}: {str(e)[:700]}", flush=True)
            continue
        t1 = time.time()
        if q.sql is None:
            print(f"rows  {name}: {len(got)} rows {t1 - t0:.2f}s", flush=True)
            continue
        try:
            want_names, want = oracle.sql_rows(con, q.sql)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"SQLERR {name}: {str(e)[:700]}", flush=True)
            continue
        same = names == want_names and got == want
        if os.environ.get("CHECK_TYPES"):
            kinds = {f.name: FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in df.schema}
            cur = con.execute(q.sql)
            other = {d[0]: str(d[1]) for d in cur.description}
            diff = {c: (kinds[c], other.get(c)) for c in kinds if kinds[c] != other.get(c)}
            if diff:
                print("   types", diff, flush=True)
        bad += not same
        print(f"{'ok   ' if same else 'DIFF '} {name}: {len(got)}/{len(want)} rows {t1 - t0:.2f}s sql {time.time() - t1:.2f}s", flush=True)
        if not same:
            print("   columns", names, want_names)
            for r in sorted(set(got) - set(want))[:3]:
                print("   spark", r[:300])
            for r in sorted(set(want) - set(got))[:3]:
                print("   sql  ", r[:300])
    return bad


if __name__ == "__main__":
    sys.exit(main())

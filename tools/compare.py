"""Run registered queries against their SQL twins: ``compare.py [sf] [key prefix or name ...]``."""

import importlib
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb  # noqa: E402

from textloom.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def main(argv):
    from textloom.catalog import common

    areas = os.environ.get("AREAS", "analysis,search,store,statistics,flows,suggest,streams").split(",")
    for area in areas:
        importlib.import_module(f"textloom.catalog.{area}")
    sf = f"/root/testdata/{argv[0] if argv else 'sf0.01'}"
    wanted = argv[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = []
    for key, fn in common.QUERIES.items():
        if wanted and not any(key == w or (w.endswith("*") and key.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if key not in common.ORACLES:
                print(f"{key:28s} rows-only {len(rows)} {took:.1f}s", flush=True)
                continue
            start = time.time()
            cur = con.execute(common.ORACLES[key])
            names = [d[0] for d in cur.description]
            want = canon(cur.fetchall(), names)
            dtook = time.time() - start
            got = canon(rows, df.columns)
            ok = sorted(names) == sorted(df.columns) and got == want
            print(f"{key:28s} {'ok' if ok else 'DIFF'} rows={len(got)}/{len(want)} spark={took:.1f}s duckdb={dtook:.1f}s", flush=True)
            if not ok:
                bad.append(key)
                print("   columns", sorted(df.columns), sorted(names))
                gs, ws = set(got), set(want)
                print("   only spark ", sorted(gs - ws)[:4])
                print("   only duckdb", sorted(ws - gs)[:4])
        except Exception as e:  # report and go on with the next query
            bad.append(key)
            print(f"{key:28s} FAIL {str(e)[:1200]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])

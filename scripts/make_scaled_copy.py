"""Write a key-consistent K-times copy of a test-data directory (DuckDB).

usage: python scripts/make_scaled_copy.py SRC_DIR OUT_DIR K
Every copy k offsets the keys of customer, supplier, part, orders, lineitem,
events, embeddings and conversations by k × (max key + 1), so joins stay
valid and all derived per-key results scale K times; small dimensions
(region, nation) and unused tables are copied once.  Use a scratch folder
for OUT_DIR; nothing is written to the source."""

import sys

import duckdb


def main(src: str, dst: str, k: int) -> None:
    con = duckdb.connect()

    def n(t, key):
        return con.execute(f"select max({key}) + 1 from '{src}/{t}.parquet'").fetchone()[0]

    nc, ns, np_, no = n("customer", "c_custkey"), n("supplier", "s_suppkey"), n("part", "p_partkey"), n("orders", "o_orderkey")
    ne, nv, ncv = n("events", "event_id"), n("embeddings", "vec_id"), n("conversations", "conv_id")
    rng = f"range({k}) r(k)"
    shifted = {
        "customer": f"c_custkey + k*{nc} as c_custkey, * exclude (c_custkey)",
        "supplier": f"s_suppkey + k*{ns} as s_suppkey, * exclude (s_suppkey)",
        "part": f"p_partkey + k*{np_} as p_partkey, * exclude (p_partkey)",
        "orders": f"o_orderkey + k*{no} as o_orderkey, o_custkey + k*{nc} as o_custkey, * exclude (o_orderkey, o_custkey)",
        "lineitem": (f"l_orderkey + k*{no} as l_orderkey, l_partkey + k*{np_} as l_partkey, "
                     f"l_suppkey + k*{ns} as l_suppkey, * exclude (l_orderkey, l_partkey, l_suppkey)"),
        "events": f"event_id + k*{ne} as event_id, user_id + k*{nc} as user_id, * exclude (event_id, user_id)",
        "embeddings": f"vec_id + k*{nv} as vec_id, * exclude (vec_id)",
        "conversations": f"conv_id + k*{ncv} as conv_id, * exclude (conv_id)",
    }
    for t in ("region", "nation", "documents", "pages", "benchmark", "labels", *shifted):
        cols = ", ".join(d[0] for d in con.execute(f"describe select * from '{src}/{t}.parquet'").fetchall())
        inner = (f"select {shifted[t]} from '{src}/{t}.parquet', {rng}" if t in shifted
                 else f"select * from '{src}/{t}.parquet'")
        con.execute(f"copy (select {cols} from ({inner})) to '{dst}/{t}.parquet' (format parquet)")


if __name__ == "__main__":
    main(sys.argv[1].rstrip("/"), sys.argv[2].rstrip("/"), int(sys.argv[3]))

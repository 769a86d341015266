"""Contracts of the supplied test tables, money as exact decimals."""

from __future__ import annotations

from quayside.contracts.model import Reference, Registry, TableContract, columns


def _table(name, cols, *, key=(), cluster=(), references=(), modified=None):
    return TableContract(
        name=name,
        columns=columns(cols),
        key=tuple(key),
        cluster=tuple(cluster),
        references=tuple(Reference(c, *target.split(".")) for c, target in dict(references).items()),
        modified=modified,
        comment=f"Raw copy of {name}",
    )


WAREHOUSE = Registry(
    "warehouse",
    (
        _table(
            "region",
            """
            r_regionkey bigint
            r_name string
            """,
            key=["r_regionkey"],
        ),
        _table(
            "nation",
            """
            n_nationkey bigint
            n_name string
            n_regionkey bigint
            """,
            key=["n_nationkey"],
            references={"n_regionkey": "region.r_regionkey"},
        ),
        _table(
            "customer",
            """
            c_custkey bigint
            c_name string
            c_nationkey bigint
            c_acctbal decimal(18,2)
            c_mktsegment string
            """,
            key=["c_custkey"],
            cluster=["c_custkey"],
            references={"c_nationkey": "nation.n_nationkey"},
        ),
        _table(
            "supplier",
            """
            s_suppkey bigint
            s_name string
            s_nationkey bigint
            s_acctbal decimal(18,2)
            """,
            key=["s_suppkey"],
            cluster=["s_suppkey"],
            references={"s_nationkey": "nation.n_nationkey"},
        ),
        _table(
            "part",
            """
            p_partkey bigint
            p_name string
            p_brand string
            p_type string
            p_size bigint
            p_retailprice decimal(18,2)
            """,
            key=["p_partkey"],
            cluster=["p_partkey"],
        ),
        _table(
            "orders",
            """
            o_orderkey bigint
            o_custkey bigint
            o_orderstatus string
            o_totalprice decimal(18,2)
            o_orderdate timestamp
            o_orderpriority string
            """,
            key=["o_orderkey"],
            cluster=["o_custkey", "o_orderdate"],
            references={"o_custkey": "customer.c_custkey"},
            modified="o_orderdate",
        ),
        _table(
            "lineitem",
            """
            l_orderkey bigint
            l_partkey bigint
            l_suppkey bigint
            l_linenumber bigint
            l_quantity decimal(18,2)
            l_extendedprice decimal(18,2)
            l_discount decimal(18,2)
            l_tax decimal(18,2)
            l_returnflag string
            l_linestatus string
            l_shipdate timestamp
            """,
            key=["l_orderkey", "l_linenumber"],
            cluster=["l_orderkey"],
            references={
                "l_orderkey": "orders.o_orderkey",
                "l_partkey": "part.p_partkey",
                "l_suppkey": "supplier.s_suppkey",
            },
            modified="l_shipdate",
        ),
        _table(
            "events",
            """
            event_id bigint
            ts timestamp
            user_id bigint
            event_type string
            value double
            props string
            """,
            key=["event_id"],
            cluster=["user_id"],
            modified="ts",
        ),
        _table(
            "documents",
            """
            doc_id bigint
            text string
            lang string
            source string
            n_chars bigint
            """,
            key=["doc_id"],
        ),
        _table(
            "embeddings",
            """
            vec_id bigint
            embedding array<float>
            label bigint
            """,
            key=["vec_id"],
        ),
        _table(
            "pages",
            """
            page_id bigint
            url string
            html string
            """,
            key=["page_id"],
        ),
        _table(
            "benchmark",
            """
            item_id bigint
            text string
            """,
            key=["item_id"],
        ),
        _table(
            "labels",
            """
            doc_id bigint
            quality bigint
            toxic bigint
            """,
            key=["doc_id"],
            references={"doc_id": "documents.doc_id"},
        ),
        _table(
            "conversations",
            """
            conv_id bigint
            turn bigint
            role string
            text string
            """,
            key=["conv_id", "turn"],
        ),
    ),
)

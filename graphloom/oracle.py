"""DuckDB SQL for each registered query, written independently of the Spark code.

The tables ``lineitem events pages part ...`` are views. Iterative algorithms are
unrolled into one materialized CTE per round; the stop rule of tolerance-based
PageRank is applied in SQL over the unrolled rounds. Float literals are cast to
DOUBLE (a bare ``1.0`` is DECIMAL in DuckDB).
"""

from __future__ import annotations

INF = "CAST('inf' AS DOUBLE)"
ROUND = 10  # decimals kept for ranks and shares on both sides

G_ORDERS = """
SELECT CASE WHEN l_orderkey % 2 = 1 THEN b ELSE a END AS src,
       CASE WHEN l_orderkey % 2 = 1 THEN a ELSE b END AS dst,
       min(w) AS weight
FROM (SELECT l_orderkey, min(l_partkey) AS a, max(l_partkey) AS b, sum(l_quantity) AS w
      FROM lineitem GROUP BY l_orderkey) o
WHERE a <> b
GROUP BY 1, 2
"""

G_EVENTS = """
SELECT x.user_id AS src, y.user_id AS dst, min(y.value) AS weight
FROM (SELECT event_id, min(user_id) AS user_id, min(value) AS value FROM events GROUP BY event_id) x
JOIN (SELECT event_id, min(user_id) AS user_id, min(value) AS value FROM events GROUP BY event_id) y
  ON y.event_id = x.event_id + 1
WHERE x.user_id <> y.user_id
GROUP BY 1, 2
"""

G_HREF = """
SELECT CAST(page_id AS VARCHAR) AS src,
       unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst
FROM pages
"""

GRAPH_SQL = {"g_orders": G_ORDERS, "g_events": G_EVENTS, "g_href": G_HREF}


def with_graph(graph: str, *ctes: str) -> str:
    body = ",\n".join([f"g AS ({GRAPH_SQL[graph]})", *ctes])
    return f"WITH {body}\n"


VERTICES_ALL = "v AS (SELECT src AS id FROM g UNION SELECT dst AS id FROM g)"
VERTICES_SOURCES = "v AS (SELECT DISTINCT src AS id FROM g)"
SINKS = "sinks AS (SELECT DISTINCT dst AS id FROM g WHERE dst NOT IN (SELECT src FROM g))"


# ---------------------------------------------------------------- PageRank, unrolled

def pagerank_ctes(rounds: int, mode: str = "standard", damping: float = 0.85,
                  vertices: str = "all") -> list[str]:
    d = repr(float(damping))
    ctes = [
        VERTICES_ALL if vertices == "all" else VERTICES_SOURCES,
        "outdeg AS (SELECT src, count(*) AS c FROM g GROUP BY src)",
        "deg AS (SELECT v.id, coalesce(o.c, 0) AS deg FROM v LEFT JOIN outdeg o ON v.id = o.src)",
        "nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM v)",
        "r0 AS MATERIALIZED (SELECT id, CAST(1 AS DOUBLE) / (SELECT n FROM nn) AS rank FROM v)",
    ]
    for k in range(1, rounds + 1):
        p = f"r{k - 1}"
        ctes.append(
            f"dm{k} AS (SELECT coalesce(sum(r.rank), CAST(0 AS DOUBLE)) AS dmass "
            f"FROM {p} r JOIN deg ON r.id = deg.id WHERE deg.deg = 0)"
        )
        ctes.append(
            f"s{k} AS (SELECT g.dst AS id, sum(r.rank / deg.deg) AS s, count(*) AS nin "
            f"FROM g JOIN {p} r ON g.src = r.id JOIN deg ON g.src = deg.id GROUP BY g.dst)"
        )
        base = (f"((CAST(1 AS DOUBLE) - {d}) / (SELECT n FROM nn) "
                f"+ {d} * (SELECT dmass FROM dm{k}) / (SELECT n FROM nn))")
        if mode == "standard":
            rank = f"{base} + {d} * coalesce(s.s, CAST(0 AS DOUBLE))"
        else:
            inner = f"CASE WHEN s.nin > 0 THEN {d} * s.s + {base} ELSE CAST(0 AS DOUBLE) END"
            rank = f"{d} * ({inner}) + {base}"
        ctes.append(f"r{k} AS MATERIALIZED (SELECT v.id, {rank} AS rank FROM v LEFT JOIN s{k} s ON v.id = s.id)")
    return ctes


def pagerank_sql(graph: str, rounds: int, mode: str = "standard", vertices: str = "all",
                 tol: float | None = None, select: str | None = None) -> str:
    """Ranks after ``rounds`` rounds, or at the first round whose L1 change is below ``tol``.

    ``select`` is applied to a CTE ``final(id, rank)``.
    """
    ctes = pagerank_ctes(rounds, mode, vertices=vertices)
    if tol is None:
        ctes.append(f"final AS (SELECT id, rank FROM r{rounds})")
    else:
        diffs = ["SELECT 1 AS k, sum(abs(rank)) AS diff FROM r1"] + [
            f"SELECT {k} AS k, sum(abs(a.rank - b.rank)) AS diff FROM r{k} a JOIN r{k - 1} b ON a.id = b.id"
            for k in range(2, rounds + 1)
        ]
        ctes.append("diffs AS (" + " UNION ALL ".join(diffs) + ")")
        ctes.append(f"stop AS (SELECT coalesce(min(k) FILTER (WHERE diff < {tol!r}), {rounds}) AS k FROM diffs)")
        allr = " UNION ALL ".join(f"SELECT {k} AS k, id, rank FROM r{k}" for k in range(1, rounds + 1))
        ctes.append(f"allr AS ({allr})")
        ctes.append("final AS (SELECT id, rank FROM allr WHERE k = (SELECT k FROM stop))")
    select = select or f"SELECT id, round(rank, {ROUND}) AS rank FROM final"
    return with_graph(graph, *ctes) + select


def pagerank_history_sql(graph: str, rounds: int) -> str:
    ctes = pagerank_ctes(rounds)
    allr = " UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS round, id, rank FROM r{k}" for k in range(1, rounds + 1)
    )
    return with_graph(graph, *ctes) + f"SELECT round, id, round(rank, {ROUND}) AS rank FROM ({allr}) h"


# ---------------------------------------------------------------- shortest paths, unrolled

def sssp_ctes(rounds: int, source_sql: str = "(SELECT min(src) FROM g)") -> list[str]:
    ctes = [
        VERTICES_ALL,
        "e AS (SELECT src, dst, min(weight) AS w FROM g GROUP BY src, dst)",
        f"d0 AS MATERIALIZED (SELECT id, CASE WHEN id = {source_sql} THEN CAST(0 AS DOUBLE) ELSE {INF} END AS dist FROM v)",
    ]
    for k in range(1, rounds + 1):
        p = f"d{k - 1}"
        ctes.append(
            f"d{k} AS MATERIALIZED (SELECT d.id, least(d.dist, coalesce(c.best, {INF})) AS dist "
            f"FROM {p} d LEFT JOIN (SELECT e.dst AS id, min(q.dist + e.w) AS best FROM e JOIN {p} q "
            f"ON e.src = q.id WHERE q.dist < {INF} GROUP BY e.dst) c ON d.id = c.id)"
        )
    return ctes


def finite(col: str) -> str:
    return f"CASE WHEN {col} = {INF} THEN NULL ELSE {col} END"


def sssp_sql(graph: str, rounds: int) -> str:
    return with_graph(graph, *sssp_ctes(rounds)) + f"SELECT id, {finite('dist')} AS dist FROM d{rounds}"


def sssp_shifted_sql(graph: str, rounds: int, factor: int, modulus: int) -> str:
    """Distances under potentials, by those without: a path gains its source's potential and loses its target's."""
    pot = lambda c: f"(({c} * {factor}) % {modulus})"
    return with_graph(graph, *sssp_ctes(rounds)) + (
        f"SELECT id, {finite('dist')} + {pot('(SELECT min(src) FROM g)')} - {pot('id')} AS dist FROM d{rounds}"
    )


def sssp_target_sql(graph: str, rounds: int) -> str:
    return with_graph(graph, *sssp_ctes(rounds)) + (
        f"SELECT (SELECT min(src) FROM g) AS source, id AS target, {finite('dist')} AS dist "
        f"FROM d{rounds} WHERE id = (SELECT max(id) FROM v)"
    )


def sssp_rounds_sql(graph: str, rounds: int) -> str:
    changed = " + ".join(
        f"(CASE WHEN EXISTS (SELECT 1 FROM d{k} a JOIN d{k - 1} b ON a.id = b.id WHERE a.dist < b.dist) "
        f"THEN 1 ELSE 0 END)"
        for k in range(1, rounds + 1)
    )
    return with_graph(graph, *sssp_ctes(rounds)) + (
        f"SELECT CAST({changed} AS BIGINT) AS improving_rounds, "
        f"(SELECT count(*) FROM d{rounds} WHERE dist < {INF}) AS reached"
    )

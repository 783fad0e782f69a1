"""SQL that grows a tree by trying every split, to compare fitted trees with.

For each node, feature and value it adds up rows and targets, runs the sums along the
values, and takes the split of the greatest gain: the feature that comes first on a tie,
then the smallest value. One-hot features are ordered by their mean target, as Spark orders
categories. A node whose two leaves predict the same is a leaf, as in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence


def _impurity(kind: str, n: str, s: str, q: str) -> str:
    if kind == "variance":
        return f"(({q} - ({s} * {s}) / {n}) / {n})"
    return f"((1e0 - (({n} - {s}) / {n}) * (({n} - {s}) / {n})) - ({s} / {n}) * ({s} / {n}))"


def tree_tables(
    source: str,
    key: str,
    target: str,
    trained: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    depth: int,
    kind: str,
) -> str:
    """Common tables ``nodes`` (place, split and value of each node) and ``ends`` (rows by leaf).

    ``source`` has the rows, ``trained`` is the condition of those that the tree is fitted
    on, ``kind`` is ``variance`` or ``gini``.
    """
    parts = [
        f"""SELECT rid, y, trained, {i} AS block, value, '{c}_' || value AS feature, TRUE AS one_hot,
    CASE WHEN {c} = value THEN 1e0 ELSE 0e0 END AS v
  FROM based, (SELECT DISTINCT {c} AS value FROM based WHERE trained AND {c} IS NOT NULL)"""
        for i, c in enumerate(categorical)
    ]
    parts += [
        f"""SELECT rid, y, trained, {len(categorical) + i} AS block, '' AS value, '{c}' AS feature,
    FALSE AS one_hot, cast({c} AS double) AS v FROM based"""
        for i, c in enumerate(numeric)
    ]
    cells = "\n  UNION ALL ".join(parts)
    tables = [
        f"""based AS MATERIALIZED (
  SELECT {key}, cast({target} AS double) AS y, {trained} AS trained,
    row_number() OVER (ORDER BY {key}) AS rid, {", ".join([*categorical, *numeric])} FROM {source})""",
        f"cells AS MATERIALIZED (\n  {cells})",
        "at0 AS MATERIALIZED (SELECT rid, 'T' AS place FROM based)",
    ]
    for level in range(depth + 1):
        tables.append(f"""sums{level} AS MATERIALIZED (
  SELECT place, count(*)::DOUBLE AS n, sum(y) AS s, sum(y * y) AS q
  FROM at{level} JOIN based USING (rid) WHERE trained GROUP BY place)""")
        if level == depth:
            break
        tables.append(f"""best{level} AS MATERIALIZED (
  SELECT place, block, value, feature, one_hot, threshold, left_value, gain FROM (
    SELECT *, CASE WHEN one_hot THEN NULL ELSE (v + above) / 2 END AS threshold,
      CASE WHEN one_hot THEN v END AS left_value,
      {_impurity(kind, "n", "s", "q")} - (ln / n) * {_impurity(kind, "ln", "ls", "lq")}
        - ((n - ln) / n) * {_impurity(kind, "(n - ln)", "(s - ls)", "(q - lq)")} AS gain
    FROM (
      SELECT place, block, value, feature, one_hot, v, along,
        sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(q) OVER w AS lq, lead(v) OVER w AS above
      FROM (
        SELECT place, block, value, feature, one_hot, v, count(*)::DOUBLE AS n, sum(y) AS s,
          sum(y * y) AS q, CASE WHEN one_hot THEN sum(y) / count(*) ELSE v END AS along
        FROM at{level} JOIN cells USING (rid) WHERE trained
        GROUP BY place, block, value, feature, one_hot, v)
      WINDOW w AS (PARTITION BY place, block, value ORDER BY along, v))
    JOIN sums{level} USING (place) WHERE above IS NOT NULL)
  WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY place ORDER BY gain DESC, block, value, along, v) = 1)""")
        tables.append(f"""at{level + 1} AS MATERIALIZED (
  SELECT rid, place || CASE WHEN v = left_value OR v <= threshold THEN 'L' ELSE 'R' END AS place
  FROM at{level} JOIN best{level} USING (place) JOIN cells USING (rid, block, value))""")

    value = "s / n" if kind == "variance" else "CASE WHEN s > n - s THEN 1e0 ELSE 0e0 END"
    tables.append(f"""grown{depth} AS (
  SELECT place, n, {value} AS prediction, s / n AS share, NULL::VARCHAR AS feature,
    NULL::DOUBLE AS threshold, NULL::DOUBLE AS left_value, NULL::DOUBLE AS gain FROM sums{depth})""")
    for level in reversed(range(depth)):
        tables.append(f"""leaves{level} AS (
  SELECT substr(place, 1, {level + 1}) AS place FROM grown{level + 1}
  WHERE length(place) = {level + 2} GROUP BY substr(place, 1, {level + 1})
  HAVING count(feature) > 0 OR min(prediction) <> max(prediction))""")
        tables.append(f"""grown{level} AS (
  SELECT place, n, {value} AS prediction, s / n AS share, feature, threshold, left_value, gain
  FROM sums{level} LEFT JOIN (best{level} JOIN leaves{level} USING (place)) USING (place)
  UNION ALL SELECT * FROM grown{level + 1} WHERE substr(place, 1, {level + 1}) IN (SELECT place FROM leaves{level}))""")
    tables.append("nodes AS (SELECT * FROM grown0)")
    ends = "\n  UNION ALL ".join(
        f"SELECT rid, prediction, share FROM at{level} JOIN nodes USING (place) WHERE feature IS NULL"
        for level in range(depth + 1)
    )
    tables.append(f"ends AS (\n  {ends})")
    return ",\n".join(tables)


NODES = """SELECT place, feature, threshold, left_value, cast(n AS bigint) AS rows,
  round(gain + 1e-9, 6) AS gain, round(prediction + 1e-9, 6) AS prediction FROM nodes"""

IMPORTANCE = """(
  SELECT f.feature, coalesce(weight / (SELECT sum(gain * n) FROM nodes), 0e0) AS importance
  FROM (SELECT DISTINCT feature FROM cells WHERE trained) f
  LEFT JOIN (SELECT feature, sum(gain * n) AS weight FROM nodes WHERE feature IS NOT NULL GROUP BY feature) w
    ON w.feature = f.feature)"""

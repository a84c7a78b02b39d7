"""Oracle SQL (DuckDB dialect) for the registered queries.

The stand-in CTEs mirror ``cadenza.sources.standins`` one for one; the fixed
values (genre names, moduli, uri prefixes) are the same constants.
"""

from __future__ import annotations

from cadenza.sources.standins import (
    ARTIST_PREFIX,
    GENRE_NAMES,
    NO_CREATOR_MODULUS,
    NO_FEATURE_MODULUS,
    TRACK_PREFIX,
)

_GENRES = "[" + ", ".join(f"'{g}'" for g in GENRE_NAMES) + "]"

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "followers": ((), "SELECT o_custkey, count(*) AS num_followers FROM orders GROUP BY o_custkey"),
    "heads": (
        ("followers",),
        "SELECT o.o_orderkey AS pid, f.num_followers FROM orders o JOIN followers f USING (o_custkey)",
    ),
    "occ": (
        ("heads",),
        f"""SELECT l.l_orderkey AS pid, l.l_linenumber AS pos,
                  '{TRACK_PREFIX}' || CASE WHEN l.l_partkey % {NO_FEATURE_MODULUS} = 0 THEN '-' ELSE '' END
                    || CAST(l.l_partkey AS VARCHAR) AS track_uri,
                  '{ARTIST_PREFIX}' || CASE WHEN l.l_suppkey % {NO_CREATOR_MODULUS} = 0 THEN '-' ELSE '' END
                    || CAST(l.l_suppkey AS VARCHAR) AS artist_uri,
                  l.l_quantity AS duration_ms, h.num_followers,
                  l.l_partkey, l.l_suppkey
           FROM lineitem l JOIN heads h ON h.pid = l.l_orderkey""",
    ),
    "occn": (
        ("occ",),
        """SELECT o.*, p.p_name AS track_name, p.p_brand AS album_name, s.s_name AS artist_name
           FROM occ o LEFT JOIN part p ON p.p_partkey = o.l_partkey
                      LEFT JOIN supplier s ON s.s_suppkey = o.l_suppkey""",
    ),
    "feats": (
        (),
        f"""SELECT '{TRACK_PREFIX}' || CAST(p_partkey AS VARCHAR) AS uri, CAST(p_partkey AS VARCHAR) AS id,
                  p_size, p_retailprice
           FROM part""",
    ),
    "creators": (
        (),
        f"""SELECT list_slice({_GENRES}, 1, CAST(s_suppkey % 6 AS INTEGER)) AS genres,
                  CAST(s_suppkey AS VARCHAR) AS id, s_name AS name,
                  '{ARTIST_PREFIX}' || CAST(s_suppkey AS VARCHAR) AS uri
           FROM supplier""",
    ),
    "per_order": (
        (),
        """SELECT l.l_orderkey AS pid, count(*) AS num_tracks, count(DISTINCT l.l_suppkey) AS num_artists,
                  count(DISTINCT p.p_brand) AS num_albums, sum(l.l_quantity) AS duration_ms
           FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_orderkey""",
    ),
    "colls": (
        ("followers", "per_order"),
        """SELECT o.o_orderkey AS pid, o.o_orderpriority AS name, d.text AS description,
                  o.o_orderstatus AS collaborative, CAST(epoch(o.o_orderdate) AS BIGINT) AS modified_at,
                  coalesce(po.num_tracks, 0) AS num_tracks, coalesce(po.num_artists, 0) AS num_artists,
                  coalesce(po.num_albums, 0) AS num_albums, coalesce(po.duration_ms, 0.0) AS duration_ms,
                  f.num_followers
           FROM orders o JOIN followers f USING (o_custkey)
                LEFT JOIN per_order po ON po.pid = o.o_orderkey
                LEFT JOIN documents d ON d.doc_id = o.o_orderkey""",
    ),
    # C1 building blocks
    "joined_feats": (
        ("occ", "feats"),
        "SELECT o.pid, o.num_followers, f.p_size, f.p_retailprice FROM occ o LEFT JOIN feats f ON f.uri = o.track_uri",
    ),
    "mean_coll": (
        ("joined_feats",),
        """SELECT pid, avg(num_followers) AS num_followers, avg(p_size) AS p_size, avg(p_retailprice) AS p_retailprice
           FROM joined_feats GROUP BY pid""",
    ),
    "median_coll": (
        ("joined_feats",),
        """SELECT pid, quantile_cont(num_followers, 0.5) AS num_followers, quantile_cont(p_size, 0.5) AS p_size,
                  quantile_cont(p_retailprice, 0.5) AS p_retailprice
           FROM joined_feats GROUP BY pid""",
    ),
    "main_coll": (("colls",), "SELECT pid, num_tracks, num_artists, num_albums FROM colls"),
    "genre_coll": (
        ("occ", "creators"),
        """SELECT o.pid, avg(len(c.genres)) AS genre_count, avg(o.num_followers) AS num_followers
           FROM occ o LEFT JOIN creators c ON c.uri = o.artist_uri GROUP BY o.pid""",
    ),
    "ftable": (
        ("mean_coll", "main_coll", "genre_coll"),
        """SELECT m.pid, m.num_followers, m.p_size, m.p_retailprice, mc.num_tracks, mc.num_artists,
                  mc.num_albums, g.genre_count
           FROM mean_coll m LEFT JOIN main_coll mc USING (pid) LEFT JOIN genre_coll g USING (pid)""",
    ),
}


def _resolve(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def with_ctes(uses: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named stand-in CTEs (and their dependencies), then ``body``."""
    parts = [f"{n} AS ({CTES[n][1]})" for n in _resolve(uses)]
    for n, sql in (extra or {}).items():
        parts.append(f"{n} AS ({sql})")
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


def r(expr: str, digits: int = 6) -> str:
    """Round a float expression the way the Spark side does (``+ 0.0`` turns -0.0 into 0.0)."""
    return f"(round({expr}, {digits}) + 0.0)"

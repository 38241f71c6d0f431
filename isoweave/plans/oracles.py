"""The steps of the engine once more, as relational SQL for DuckDB: what the registered queries are checked against."""

from . import fixtures

#: name -> (needs, SQL); array work is done on exploded rows, so that it does not mirror the expressions it checks.
STEPS: dict[str, tuple[list[str], str]] = {
    "o_blocks": (
        ["v_reads"],
        """SELECT name, cell, umi, chrom, flag, gx, g, n, pos, cigar, mapq, l_orderkey, a, b FROM (
            SELECT r.*, pos AS a, pos + CASE WHEN n <= 4 THEN 40 ELSE 20 END AS b FROM v_reads r
            UNION ALL SELECT r.*, pos + 20 + CASE WHEN n = 5 THEN 1700 ELSE 3700 END, pos + 40 + CASE WHEN n = 5 THEN 1700 ELSE 3700 END FROM v_reads r WHERE n >= 5)""",
    ),
    "o_events": (
        ["v_reads", "x_bounds", "v_cells"],
        """SELECT r.*, w.gene_id, CASE WHEN flag & 2820 <> 0 THEN 'nonprimary' WHEN c.cell IS NULL THEN 'unfiltered_barcode' WHEN umi = '' THEN 'missing_ub'
            WHEN gx IS NULL THEN 'missing_gx' WHEN contains(gx, ';') THEN 'multigene_gx'
            WHEN regexp_replace(gx, '\\.[0-9]+$', '') <> w.gene_id THEN 'other_gene_gx'
            WHEN (CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END) <> w.strand THEN 'wrong_strand' END AS reason
            FROM v_reads r JOIN x_bounds w ON r.chrom = w.chrom AND r.pos < w.hi AND r.pos + CASE WHEN n <= 4 THEN 40 WHEN n = 5 THEN 1740 ELSE 3740 END > w.lo
            LEFT JOIN (SELECT DISTINCT cell FROM v_cells) c ON r.cell = c.cell""",
    ),
    "o_ok": (["o_events"], "SELECT * FROM o_events WHERE reason IS NULL"),
    "o_rawblocks": (
        ["o_ok"],
        """SELECT DISTINCT cell, umi, gene_id, a, b FROM (SELECT *, pos AS a, pos + CASE WHEN n <= 4 THEN 40 ELSE 20 END AS b FROM o_ok
            UNION ALL SELECT *, pos + 20 + CASE WHEN n = 5 THEN 1700 ELSE 3700 END, pos + 40 + CASE WHEN n = 5 THEN 1700 ELSE 3700 END FROM o_ok WHERE n >= 5)""",
    ),
    "o_mblocks": (  # gaps and islands
        ["o_rawblocks"],
        """SELECT cell, umi, gene_id, MIN(a) AS a, MAX(b) AS b FROM (SELECT *, SUM(fresh) OVER (PARTITION BY cell, umi, gene_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM (
            SELECT *, CASE WHEN a <= MAX(b) OVER (PARTITION BY cell, umi, gene_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM o_rawblocks))
            GROUP BY cell, umi, gene_id, island""",
    ),
    "o_mjunctions": (["o_ok"], "SELECT DISTINCT cell, umi, gene_id, pos + 20 AS a, pos + 20 + CASE WHEN n = 5 THEN 1700 ELSE 3700 END AS b FROM o_ok WHERE n >= 5"),
    "o_mol": (
        ["o_mblocks", "o_mjunctions"],
        """SELECT m.cell, m.umi, m.gene_id, blocks, COALESCE(junctions, '') AS junctions, lo, hi FROM
            (SELECT cell, umi, gene_id, string_agg(concat(a, '-', b), ';' ORDER BY a) AS blocks, MIN(a) AS lo, MAX(b) AS hi FROM o_mblocks GROUP BY ALL) m
            LEFT JOIN (SELECT cell, umi, gene_id, string_agg(concat(a, '-', b), ';' ORDER BY a, b) AS junctions FROM o_mjunctions GROUP BY ALL) j USING (cell, umi, gene_id)""",
    ),
    "o_shape": (["o_mol"], "SELECT gene_id, blocks, junctions, ANY_VALUE(lo) AS lo, ANY_VALUE(hi) AS hi, MIN(concat(cell, '|', umi)) AS one FROM o_mol GROUP BY gene_id, blocks, junctions"),
    "o_introns": (["v_exon"], "SELECT id, b AS a, LEAD(a) OVER (PARTITION BY id ORDER BY a) AS b FROM v_exon"),
    "o_misfit": (
        ["o_shape", "o_mblocks", "o_mjunctions", "v_exon", "o_introns", "v_meta"],
        """SELECT DISTINCT gene_id, blocks, junctions, id FROM (
            SELECT s.gene_id, s.blocks, s.junctions, t.id FROM o_shape s JOIN v_meta t USING (gene_id) JOIN o_mblocks m ON concat(m.cell, '|', m.umi) = s.one AND m.gene_id = s.gene_id
              LEFT JOIN v_exon e ON e.id = t.id AND e.a <= m.a AND m.b <= e.b WHERE e.id IS NULL
            UNION ALL SELECT s.gene_id, s.blocks, s.junctions, t.id FROM o_shape s JOIN v_meta t USING (gene_id) JOIN o_mjunctions m ON concat(m.cell, '|', m.umi) = s.one AND m.gene_id = s.gene_id
              LEFT JOIN o_introns e ON e.id = t.id AND e.a = m.a AND m.b = e.b WHERE e.id IS NULL)""",
    ),
    "o_fit": (
        ["o_shape", "v_meta", "o_misfit"],
        "SELECT s.gene_id, s.blocks, s.junctions, s.lo, s.hi, t.id, t.strand FROM o_shape s JOIN v_meta t USING (gene_id) ANTI JOIN o_misfit x ON x.gene_id = s.gene_id AND x.blocks = s.blocks AND x.junctions = s.junctions AND x.id = t.id",
    ),
    "o_dist": (
        ["o_fit", "v_exon"],
        """SELECT f.gene_id, f.blocks, f.junctions, f.id, CAST(SUM(CASE WHEN f.strand = '+' THEN GREATEST(0, e.b - GREATEST(e.a, f.hi)) ELSE GREATEST(0, LEAST(e.b, f.lo) - e.a) END) AS BIGINT) AS d
            FROM o_fit f JOIN v_exon e ON e.id = f.id GROUP BY f.gene_id, f.blocks, f.junctions, f.id""",
    ),
    "o_train": (
        ["o_dist", "o_mol", "v_exon"],
        """SELECT m.gene_id, m.cell, m.umi, d, c.chrom, c.a, c.first_id FROM o_mol m JOIN (SELECT gene_id, blocks, junctions, MIN(d) AS d FROM o_dist GROUP BY ALL HAVING COUNT(*) = 1) o USING (gene_id, blocks, junctions)
            JOIN (SELECT gene_id, chrom, MIN(a) AS a, MIN_BY(id, (a, id)) AS first_id FROM (SELECT gene_id, chrom, id, MIN(a) AS a FROM v_exon GROUP BY ALL) GROUP BY gene_id, chrom) c USING (gene_id)""",
    ),
    "o_samples": (["o_train"], "SELECT d FROM (SELECT d FROM o_train ORDER BY chrom, a, gene_id, cell, umi LIMIT 2000)"),
    "o_density": (
        ["o_dist", "o_samples"],
        """SELECT d, MAX(x) + ln(SUM(exp(x - top))) - ln(MAX(n) * 30.0 * sqrt(2 * pi())) AS f FROM (SELECT q.d, x, MAX(x) OVER (PARTITION BY q.d) AS top, n FROM (
            SELECT d.d, -0.5 * pow((d.d - s.d) / 30.0, 2) AS x FROM (SELECT DISTINCT d FROM o_dist) d, o_samples s UNION ALL SELECT d.d, -0.5 * pow((d.d + s.d) / 30.0, 2) FROM (SELECT DISTINCT d FROM o_dist) d, o_samples s) q,
            (SELECT COUNT(*) AS n FROM o_samples)) GROUP BY d""",
    ),
    "o_like": (
        ["o_shape", "v_meta", "o_dist", "o_density"],
        """SELECT s.gene_id, s.blocks, s.junctions, t.id, COALESCE(exp(f - MAX(f) OVER (PARTITION BY s.gene_id, s.blocks, s.junctions)), 0.0) AS "like"
            FROM o_shape s JOIN v_meta t USING (gene_id) LEFT JOIN o_dist d ON d.gene_id = s.gene_id AND d.blocks = s.blocks AND d.junctions = s.junctions AND d.id = t.id LEFT JOIN o_density f ON f.d = d.d""",
    ),
    "o_prior": (
        ["v_meta"],
        """SELECT *, CASE WHEN lr + 10.0 > 0 THEN (lr_count + 10.0 * share) / (lr + 10.0) ELSE share END AS prior FROM (SELECT *, SUM(lr_count) OVER (PARTITION BY gene_id) AS lr,
            CASE WHEN SUM(tpm) OVER (PARTITION BY gene_id) > 0 THEN tpm / SUM(tpm) OVER (PARTITION BY gene_id) ELSE 1.0 / COUNT(*) OVER (PARTITION BY gene_id) END AS share FROM v_meta)""",
    ),
    "o_terminal": (  # cumulative lengths from the 3' end
        ["v_exon"],
        """SELECT id, string_agg(concat(CASE WHEN strand = '+' THEN b - len ELSE a END, '-', CASE WHEN strand = '+' THEN b ELSE a + len END), ';' ORDER BY r) AS terminal FROM (
            SELECT *, LEAST(b - a, 600 - before) AS len FROM (SELECT *, COALESCE(SUM(b - a) OVER (PARTITION BY id ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
              SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY CASE WHEN strand = '+' THEN -a ELSE a END) AS r FROM v_exon)) WHERE before < 600) GROUP BY id""",
    ),
    "o_group": (
        ["o_prior", "o_terminal", "o_like"],
        """SELECT gene_id, id, prior, grp, CASE WHEN SUM(prior) OVER (PARTITION BY gene_id, grp) > 0 THEN prior / SUM(prior) OVER (PARTITION BY gene_id, grp) ELSE 1.0 / COUNT(*) OVER (PARTITION BY gene_id, grp) END AS weight FROM (
            SELECT *, DENSE_RANK() OVER (PARTITION BY gene_id ORDER BY s_min, c_min) AS grp FROM (
              SELECT p.gene_id, p.id, p.prior, MIN(p.id) OVER (PARTITION BY p.gene_id, p.chrom, p.strand, t.terminal) AS s_min, MIN(p.id) OVER (PARTITION BY p.gene_id, p.chrom, p.strand, t.terminal, sig) AS c_min
              FROM o_prior p JOIN o_terminal t USING (id) LEFT JOIN (SELECT gene_id, id, string_agg("like"::VARCHAR, ',' ORDER BY blocks, junctions) AS sig FROM o_like GROUP BY ALL) c ON c.id = p.id))""",
    ),
    "o_grouplike": (["o_like", "o_group"], "SELECT l.gene_id, blocks, junctions, grp, SUM(\"like\" * weight) AS gl FROM o_like l JOIN o_group g USING (gene_id, id) GROUP BY l.gene_id, blocks, junctions, grp"),
    "o_rows": (
        ["o_grouplike", "o_mol"],
        """SELECT m.gene_id, m.cell, "row", COUNT(*)::DOUBLE AS n FROM o_mol m JOIN (SELECT gene_id, blocks, junctions, list(gl / top ORDER BY grp) AS "row" FROM (
            SELECT *, MAX(gl) OVER (PARTITION BY gene_id, blocks, junctions) AS top, SUM(gl) OVER (PARTITION BY gene_id, blocks, junctions) AS total FROM o_grouplike) WHERE total > 0 GROUP BY gene_id, blocks, junctions) r USING (gene_id, blocks, junctions)
            GROUP BY m.gene_id, m.cell, "row" """,
    ),
    "o_em": (
        ["o_rows", "o_group"],
        """SELECT * FROM (WITH RECURSIVE fit AS (
            SELECT gene_id, cell, list("row" ORDER BY "row") AS ls, list(n ORDER BY "row") AS ns, SUM(n) AS total, ANY_VALUE(pi) AS pi, [1.0 / len(ANY_VALUE(pi)) FOR x IN ANY_VALUE(pi)] AS a, 0 AS it, 1.0::DOUBLE AS delta
            FROM o_rows JOIN (SELECT gene_id, list(p ORDER BY grp) AS pi FROM (SELECT gene_id, grp, SUM(prior) AS p FROM o_group GROUP BY ALL) GROUP BY gene_id) USING (gene_id) GROUP BY gene_id, cell
            UNION ALL
            SELECT gene_id, cell, ls, ns, total, pi, new, it + 1, list_max(list_transform(list_zip(new, a), lambda z: abs(z[1] - z[2]))) FROM (
              SELECT *, list_transform(raw, lambda x: x / list_sum(raw)) AS new FROM (
                SELECT *, list_transform(range(1, len(a) + 1), lambda k: greatest((list_sum(list_transform(range(1, len(ls) + 1), lambda m: ns[m] * ls[m][k] * a[k] / list_dot_product(ls[m], a))) + pi[k]) / (total + 1.0), 1e-300)) AS raw
                FROM fit WHERE it < 500 AND delta >= 1e-7)))
            SELECT gene_id, cell, it, delta < 1e-7 AS converged, total, list_transform(range(1, len(a) + 1), lambda k: list_sum(list_transform(range(1, len(ls) + 1), lambda m: ns[m] * ls[m][k] * a[k] / list_dot_product(ls[m], a)))) AS counts
            FROM fit QUALIFY ROW_NUMBER() OVER (PARTITION BY gene_id, cell ORDER BY it DESC) = 1)""",
    ),
    "o_counts": (["o_em", "o_group"], "SELECT e.cell, e.gene_id, g.id, counts[grp] * weight AS \"count\" FROM o_em e JOIN o_group g USING (gene_id)"),
}


def sql(select: str, *needs: str) -> str:
    """A query text with the CTEs of all steps and views that it needs."""
    out: dict[str, str] = {}

    def add(n: str) -> None:
        if n in STEPS:
            for need in STEPS[n][0]:
                add(need)
            out.setdefault(n, STEPS[n][1])
        else:
            for k, v in fixtures.ctes(n):
                out.setdefault(k, v)

    for n in needs:
        add(n)
    if not out:
        return select
    return "WITH " + ",\n".join(f"{k} AS MATERIALIZED ({v})" for k, v in out.items()) + "\n" + select


#: Steps that differ with observed ends: every end has its own distance and share of the likelihood.
ENDS: dict[str, str] = {
    "o_dist_tes": """SELECT f.gene_id, f.blocks, f.junctions, f.id, w / SUM(w) OVER (PARTITION BY f.gene_id, f.blocks, f.junctions, f.id) AS share,
        CASE WHEN f.strand = '+' AND tes < x.last_a OR f.strand = '-' AND tes > x.first_b THEN -1 ELSE f.d + CASE WHEN f.strand = '+' THEN tes - x.hi ELSE x.lo - tes END END AS d
        FROM (SELECT o_dist.*, strand FROM o_dist JOIN v_meta USING (gene_id, id)) f JOIN (SELECT id, MIN(a) AS lo, MAX(b) AS hi, MAX(a) AS last_a, MIN(b) AS first_b FROM v_exon GROUP BY id) x ON x.id = f.id
        JOIN (SELECT id, tes, weight AS w FROM v_tes WHERE weight > 0 UNION ALL SELECT id, CASE WHEN strand = '+' THEN MAX(b) ELSE MIN(a) END, 1.0 FROM v_exon WHERE id NOT IN (SELECT id FROM v_tes WHERE weight > 0) GROUP BY id, strand) t ON t.id = f.id""",
    "o_density_tes": """SELECT d, MAX(x) + ln(SUM(exp(x - top))) - ln(MAX(n) * 30.0 * sqrt(2 * pi())) AS f FROM (SELECT q.d, x, MAX(x) OVER (PARTITION BY q.d) AS top, n FROM (
        SELECT d.d, -0.5 * pow((d.d + sgn.v * s.d) / 30.0, 2) AS x FROM (SELECT DISTINCT d FROM o_dist_tes WHERE d >= 0) d, o_samples s, (VALUES (1), (-1)) sgn(v)) q, (SELECT COUNT(*) AS n FROM o_samples)) GROUP BY d""",
    "o_log_tes": """SELECT gene_id, blocks, junctions, id, MAX(term) + ln(SUM(exp(term - top))) AS f FROM (SELECT t.*, ln(share) + f AS term, MAX(ln(share) + f) OVER (PARTITION BY gene_id, blocks, junctions, id) AS top
        FROM o_dist_tes t JOIN o_density_tes y ON y.d = t.d) GROUP BY gene_id, blocks, junctions, id""",
    "o_like_tes": """SELECT s.gene_id, s.blocks, s.junctions, t.id, COALESCE(exp(f - MAX(f) OVER (PARTITION BY s.gene_id, s.blocks, s.junctions)), 0.0) AS "like"
        FROM o_shape s JOIN v_meta t USING (gene_id) LEFT JOIN o_log_tes d ON d.gene_id = s.gene_id AND d.blocks = s.blocks AND d.junctions = s.junctions AND d.id = t.id""",
}


#: What is asked of each variant, whose name and table of counts stand for v and t.
TOTALS = """SELECT gene_id, id AS transcript_id, round(SUM("count"), 3) AS total, '{v}' AS variant FROM {t} GROUP BY gene_id, id"""


def variants_sql(select: str = TOTALS) -> str:
    """Totals per transcript, or another select, of a run by annotated ends, by observed ends and without long-read counts: the later steps once for each."""
    import re

    later = ["o_prior", "o_group", "o_grouplike", "o_rows", "o_em", "o_counts"]
    extra = dict(ENDS)
    for tag, own in (("tes", {"o_like": "o_like_tes"}), ("sr", {})):
        names = own | {n: f"{n}_{tag}" for n in later}
        for n in later:
            text = STEPS[n][1].replace("lr_count", "0.0") if (tag, n) == ("sr", "o_prior") else STEPS[n][1]
            extra[f"{n}_{tag}"] = re.sub(r"\b(o_[a-z]+)\b", lambda m, names=names: names.get(m[1], m[1]), text)
    parts = " UNION ALL ".join(select.format(v=v, t=t) for v, t in (("annotation_tes", "o_counts"), ("empirical_tes", "o_counts_tes"), ("sr_only", "o_counts_sr")))
    base = sql("", "o_counts", "v_tes")
    return base.rstrip() + ",\n" + ",\n".join(f"{k} AS MATERIALIZED ({v})" for k, v in extra.items()) + "\n" + parts

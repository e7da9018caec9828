"""SQL for DuckDB that gives the rows of the registered queries, written apart from the operators."""

from __future__ import annotations

from satloom.plans.views import HIT_ROWS, ctes

SCANNED = """scan AS (SELECT p.entry_id, p.period, CAST(count(*) AS BIGINT) AS n_blocks, max(l.copy_number_c) AS max_copy_number,
  CAST(sum(CASE WHEN l.copy_number_c >= 10000 THEN 1 ELSE 0 END) AS BIGINT) AS n_loci_ge_min_copy_number, count(DISTINCT l.source_seq) AS n_distinct_source_seqs,
  CAST(sum(l.end_pos - l.start_pos) AS BIGINT) AS total_array_bp, CAST(sum(l.percent_match) AS DOUBLE) / count(*) AS mean_percent_match
  FROM (SELECT DISTINCT entry_id, period FROM loci WHERE period >= 150) p JOIN loci l ON l.entry_id = p.entry_id AND l.period BETWEEN p.period - 5 AND p.period + 5
  GROUP BY p.entry_id, p.period),
 ruled AS (SELECT *, max_copy_number >= 10000 AND n_blocks >= 5 AS passes_distributed, max_copy_number >= 24400 AS passes_single_block FROM scan),
 ranked AS (SELECT *, passes_distributed OR passes_single_block AS passes_filters,
  row_number() OVER (PARTITION BY entry_id ORDER BY passes_single_block DESC, n_loci_ge_min_copy_number DESC, total_array_bp DESC, max_copy_number DESC, period) AS rk FROM ruled)"""

WINNERS = """st(entry_id, k, w) AS (SELECT DISTINCT entry_id, CAST(0 AS BIGINT), CAST([] AS INT[]) FROM ranked
  UNION ALL SELECT r.entry_id, st.k + 1, CASE WHEN len(list_filter(w, lambda x: abs(x - r.period) <= 5)) > 0 THEN w ELSE list_append(w, r.period) END
  FROM st JOIN ranked r ON r.entry_id = st.entry_id AND r.rk = st.k + 1),
 won AS (SELECT entry_id, unnest(arg_max(w, k)) AS period FROM st GROUP BY entry_id),
 best AS (SELECT a.entry_id, a.period, arg_min(w.period, b.rk) AS winner FROM ranked a JOIN won w ON w.entry_id = a.entry_id AND abs(w.period - a.period) <= 5
  JOIN ranked b ON b.entry_id = w.entry_id AND b.period = w.period WHERE NOT EXISTS (SELECT 1 FROM won z WHERE z.entry_id = a.entry_id AND z.period = a.period AND z.period <> w.period)
  GROUP BY a.entry_id, a.period),
 nms AS (SELECT r.entry_id, r.period, concat(CAST(min(b.period) AS VARCHAR), '-', CAST(max(b.period) AS VARCHAR)) AS suppressed_period_range,
  count(*) - 1 AS n_periods_suppressed, r.passes_filters FROM best b JOIN ranked r ON r.entry_id = b.entry_id AND r.period = b.winner GROUP BY r.entry_id, r.period, r.passes_filters)"""

COVERED = """p AS (SELECT source_seq AS seqname, start_pos AS s, end_pos AS e FROM loci WHERE period >= 150 AND copy_number_c >= 10000),
 m AS (SELECT *, max(e) OVER (PARTITION BY seqname ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM p),
 g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s - pe > 2000 THEN 1 ELSE 0 END) OVER (PARTITION BY seqname ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gid FROM m),
 likely AS (SELECT seqname, CAST(min(s) - 1 AS BIGINT) AS start0, CAST(max(e) AS BIGINT) AS end0 FROM g GROUP BY seqname, gid),
 c AS (SELECT r.seqname, r.start0 AS rs, r.end0 AS re, greatest(h.start0, r.start0) AS s, least(h.end0, r.end0) AS e
  FROM likely r JOIN hits h ON h.seqname = r.seqname AND h.start0 < r.end0 AND h.end0 > r.start0 AND h.name LIKE '%#Satellite'),
 cm AS (SELECT *, max(e) OVER (PARTITION BY seqname, rs, re ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM c),
 u AS (SELECT seqname, rs, re, CAST(sum(greatest(0, e - greatest(s, coalesce(pe, s)))) AS BIGINT) AS cov FROM cm GROUP BY seqname, rs, re),
 cov AS (SELECT r.seqname, r.start0, r.end0, r.end0 - r.start0 AS length, coalesce(u.cov, 0) AS covered_bp FROM likely r LEFT JOIN u ON u.seqname = r.seqname AND u.rs = r.start0 AND u.re = r.end0)"""

NODES = """und AS (SELECT label_a AS u, label_b AS v FROM edges UNION ALL SELECT label_b, label_a FROM edges),
 adj AS (SELECT u, list(v) AS nb FROM und GROUP BY u),
 ne AS (SELECT c.*, coalesce(nb, CAST([] AS VARCHAR[])) AS nb, row_number() OVER (PARTITION BY entry_id ORDER BY total_copy_number_d DESC, cluster_uid) AS rk
  FROM clusters c LEFT JOIN adj ON u = cluster_uid)"""

FAMILIES = NODES + """,
 se AS (SELECT DISTINCT entry_id, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS w FROM clusters
  UNION ALL SELECT n.entry_id, k + 1, CASE WHEN list_has_any(n.nb, w) THEN w ELSE list_append(w, n.cluster_uid) END FROM se JOIN ne n ON n.entry_id = se.entry_id AND n.rk = se.k + 1),
 sub AS (SELECT entry_id, unnest(arg_max(w, k)) AS uid FROM se GROUP BY entry_id),
 near AS (SELECT n.cluster_uid AS uid, arg_min(m.cluster_uid, m.rk) AS best FROM ne n JOIN und ON und.u = n.cluster_uid JOIN sub z ON z.uid = und.v JOIN ne m ON m.cluster_uid = z.uid
  WHERE m.entry_id = n.entry_id GROUP BY n.cluster_uid),
 own AS (SELECT n.cluster_uid AS uid, CASE WHEN s.uid IS NOT NULL THEN n.cluster_uid ELSE near.best END AS sub_uid FROM ne n LEFT JOIN sub s ON s.uid = n.cluster_uid LEFT JOIN near ON near.uid = n.cluster_uid),
 ng AS (SELECT n.*, row_number() OVER (ORDER BY total_copy_number_d DESC, n.entry_id, n.rk) AS g FROM ne n JOIN sub ON sub.uid = n.cluster_uid),
 sg AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS w
  UNION ALL SELECT k + 1, CASE WHEN list_has_any(n.nb, w) THEN w ELSE list_append(w, n.cluster_uid) END FROM sg JOIN ng n ON n.g = sg.k + 1),
 win AS (SELECT unnest(arg_max(w, k)) AS uid FROM sg),
 nearg AS (SELECT n.cluster_uid AS uid, arg_min(m.cluster_uid, m.g) AS best FROM ng n JOIN und ON und.u = n.cluster_uid JOIN win z ON z.uid = und.v JOIN ng m ON m.cluster_uid = z.uid GROUP BY n.cluster_uid),
 fam AS (SELECT n.cluster_uid AS uid, n.entry_id, n.g, CASE WHEN x.uid IS NOT NULL THEN n.cluster_uid ELSE nearg.best END AS winner
  FROM ng n LEFT JOIN win x ON x.uid = n.cluster_uid LEFT JOIN nearg ON nearg.uid = n.cluster_uid),
 keep AS (SELECT *, first_value(uid) OVER (PARTITION BY winner, entry_id ORDER BY g) AS keeper FROM fam),
 nm AS (SELECT n.cluster_uid AS winner, consensus_length, row_number() OVER (PARTITION BY consensus_length ORDER BY g) - 1 AS li FROM ng n JOIN win ON win.uid = n.cluster_uid),
 named AS (SELECT o.uid AS cluster_uid, k.winner, k.keeper AS entry_representative, o.uid = k.winner AS is_representative,
  'SAT' || nm.consensus_length || '_' || CASE WHEN li < 26 THEN chr(CAST(97 + li AS INT)) ELSE chr(CAST(96 + li // 26 AS INT)) || chr(CAST(97 + li % 26 AS INT)) END AS final_name
  FROM own o JOIN keep k ON k.uid = o.sub_uid JOIN nm ON nm.winner = k.winner)"""

_loci = f"WITH RECURSIVE {ctes('loci')}, {SCANNED}"
_cov = f"WITH {ctes('loci', 'hits')}, {COVERED}"
_fam = f"WITH RECURSIVE {ctes('clusters', 'edges')}, {FAMILIES}"
_hits = f"WITH h AS ({HIT_ROWS.strip()}), best AS (SELECT *, row_number() OVER (PARTITION BY query_label, repeat_name ORDER BY sw_score DESC, line_no) AS z FROM h)"
_copies = ", f AS (SELECT final_name, individual, max(total_copy_number_d) OVER (PARTITION BY final_name) AS whole, total_copy_number_d AS n FROM named JOIN clusters USING (cluster_uid))"

ORACLES: dict[str, str] = {
    "period_window_scan": f"""{_loci} SELECT entry_id, period, n_blocks, max_copy_number, n_loci_ge_min_copy_number, n_distinct_source_seqs, total_array_bp,
 round(mean_percent_match, 6) AS mean_percent_match, passes_distributed, passes_single_block, passes_filters FROM ranked""",
    "period_nms": f"{_loci}, {WINNERS} SELECT * FROM nms",
    "candidate_bins": f"{_loci}, {WINNERS} SELECT entry_id, 'cand' || period AS motif, period, CAST(5 AS INT) AS \"window\" FROM nms WHERE passes_filters",
    "extract_bins": f"""{_loci}, {WINNERS} SELECT l.entry_id, 'cand' || b.period AS motif, concat(source_seq, ':', CAST(start_pos AS VARCHAR), '-', CAST(end_pos AS VARCHAR)) AS locus_id,
 l.period, copy_number_c FROM loci l JOIN nms b ON b.entry_id = l.entry_id AND b.passes_filters AND abs(b.period - l.period) <= 5""",
    "bin_weighted_quality": f"""WITH {ctes("loci")} SELECT entry_id, period, count(*) AS n, CAST(sum(copy_number_c) AS BIGINT) AS copies,
 round(coalesce(CAST(sum(percent_match * copy_number_c) AS DOUBLE) / nullif(sum(copy_number_c), 0), 0), 6) AS mean_percent_match,
 round(coalesce(CAST(sum(entropy_c * copy_number_c) AS DOUBLE) / nullif(sum(copy_number_c), 0), 0), 6) AS mean_entropy FROM loci GROUP BY entry_id, period""",
    "locus_reference_pick": f"""WITH {ctes("loci")}, o AS (SELECT *, end_pos - start_pos AS len, row_number() OVER (PARTITION BY entry_id, period ORDER BY end_pos - start_pos) AS i,
 count(*) OVER (PARTITION BY entry_id, period) AS n FROM loci), m AS (SELECT entry_id, period, len FROM o WHERE i = n // 2 + 1)
 SELECT entry_id, period, len, start_pos, source_seq FROM (SELECT o.*, row_number() OVER (PARTITION BY entry_id, period ORDER BY start_pos, source_seq) AS z FROM o JOIN m USING (entry_id, period, len)) WHERE z = 1""",
    "satellite_region_merge": f"{_cov} SELECT seqname, start0, end0 FROM likely",
    "region_hit_coverage": f"{_cov} SELECT *, round(CAST(covered_bp AS DOUBLE) / length, 6) AS coverage_fraction, covered_bp * 2 >= length AS covered FROM cov",
    "missing_regions": f"{_cov} SELECT * FROM cov WHERE covered_bp * 2 < length",
    "coverage_recall_rollup": f"""{_cov} SELECT coalesce(seqname, 'ALL') AS seqname, CAST(sum(length) AS BIGINT) AS total_likely_bp, CAST(sum(covered_bp) AS BIGINT) AS covered_bp,
 round(CAST(sum(covered_bp) AS DOUBLE) / sum(length), 6) AS overall_bp_recall, count(*) AS n_regions, count(*) FILTER (WHERE covered_bp * 2 >= length) AS n_covered_regions,
 round(CAST(count(*) FILTER (WHERE covered_bp * 2 >= length) AS DOUBLE) / count(*), 6) AS region_recall FROM cov GROUP BY ROLLUP (seqname)""",
    "best_hit_per_label": f"{_hits} SELECT query_label, repeat_name, sw_score, line_no FROM best WHERE z = 1",
    "label_left_join_hits": f"""{_hits}, l AS (SELECT 'SAT' || c_custkey AS label, (300 + c_custkey % 101) // 2 AS n FROM customer),
 j AS (SELECT label, query_label IS NOT NULL AS has_known_hit, repeat_name, sw_score, least(query_end - query_start + 1, n) / CAST(n AS DOUBLE) AS q,
  (repeat_end - repeat_begin + 1) / CAST(repeat_end + repeat_left AS DOUBLE) AS r, query_label FROM l LEFT JOIN (SELECT * FROM best WHERE z = 1) ON label = query_label)
 SELECT label, has_known_hit, repeat_name, sw_score, CASE WHEN has_known_hit THEN round(q, 6) END AS pct_query_covered, round(r, 6) AS pct_known_repeat_covered,
 CASE WHEN has_known_hit THEN round(least(q, r), 6) END AS reciprocal_overlap FROM j""",
    "reciprocal_overlaps": f"""{_hits}, j AS (SELECT *, least(query_end - query_start + 1, 200) / 200.0 AS q, (repeat_end - repeat_begin + 1) / CAST(repeat_end + repeat_left AS DOUBLE) AS r FROM h)
 SELECT query_label, repeat_name, sw_score, strand, round(CAST(q AS DOUBLE), 6) AS pct_query, round(r, 6) AS pct_known, round(least(CAST(q AS DOUBLE), r), 6) AS reciprocal FROM j""",
    "adjacency_sets": f"""WITH {ctes("clusters", "edges")}, b AS (SELECT label_a AS uid, label_b AS o FROM edges UNION SELECT label_b, label_a FROM edges)
 SELECT uid, CAST(count(*) AS INT) AS n_neighbours, string_agg(o, ';' ORDER BY o) AS neighbours FROM b GROUP BY uid""",
    "edge_semi_join": f"""WITH {ctes("clusters", "edges")} SELECT label_a, label_b FROM edges WHERE label_a IN (SELECT cluster_uid FROM clusters WHERE assembly_method = 'asmA')
 AND label_b IN (SELECT cluster_uid FROM clusters WHERE assembly_method = 'asmA')""",
    "resolve_winners_global": f"""WITH RECURSIVE {ctes("clusters", "edges")}, {NODES}, o AS (SELECT *, row_number() OVER (ORDER BY total_copy_number_d DESC, cluster_uid) AS g FROM ne),
 sg AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS w UNION ALL SELECT k + 1, CASE WHEN list_has_any(n.nb, w) THEN w ELSE list_append(w, n.cluster_uid) END FROM sg JOIN o n ON n.g = sg.k + 1),
 win AS (SELECT unnest(arg_max(w, k)) AS uid FROM sg), near AS (SELECT und.u AS uid, arg_min(o.cluster_uid, o.g) AS best FROM und JOIN win ON win.uid = und.v JOIN o ON o.cluster_uid = win.uid GROUP BY und.u)
 SELECT o.cluster_uid, CASE WHEN win.uid IS NOT NULL THEN o.cluster_uid ELSE near.best END AS winner FROM o LEFT JOIN win ON win.uid = o.cluster_uid LEFT JOIN near ON near.uid = o.cluster_uid""",
    "resolve_two_level": f"{_fam} SELECT * FROM named",
    "family_naming": f"{_fam} SELECT final_name, winner FROM named WHERE is_representative",
    "family_provenance": f"""{_fam}, e AS (SELECT DISTINCT final_name, c.entry_id, c.individual, c.assembly_method FROM named JOIN clusters c ON c.cluster_uid = named.entry_representative),
 i AS (SELECT final_name, individual, min(entry_id) AS first_entry FROM e GROUP BY ALL), m AS (SELECT final_name, assembly_method, min(entry_id) AS first_entry FROM e GROUP BY ALL),
 ee AS (SELECT final_name, CAST(count(*) AS INT) AS n_entries_found, string_agg(entry_id, ';' ORDER BY entry_id) AS entries_found FROM e GROUP BY final_name),
 ii AS (SELECT final_name, CAST(count(*) AS INT) AS n_individuals_present, string_agg(individual, ';' ORDER BY first_entry) AS individuals_found FROM i GROUP BY final_name),
 mm AS (SELECT final_name, CAST(count(*) AS INT) AS n_methods_confirming, string_agg(assembly_method, ';' ORDER BY first_entry) AS methods_found FROM m GROUP BY final_name)
 SELECT * FROM ee JOIN ii USING (final_name) JOIN mm USING (final_name)""",
    "top_families_global": f"""{_fam}{_copies}, t AS (SELECT final_name, max(n) AS max_copy_number FROM f GROUP BY final_name)
 SELECT *, CAST(row_number() OVER (ORDER BY max_copy_number DESC, final_name) AS INT) AS place FROM t QUALIFY place <= 20""",
    "top_families_per_individual": f"""{_fam}{_copies}, t AS (SELECT individual, final_name, max(n) AS max_copy_number FROM f GROUP BY individual, final_name)
 SELECT *, CAST(row_number() OVER (PARTITION BY individual ORDER BY max_copy_number DESC, final_name) AS INT) AS place FROM t QUALIFY place <= 20""",
    "log_histogram": """WITH x AS (SELECT log10(CAST(o_totalprice AS DOUBLE)) AS x FROM orders), e AS (SELECT min(x) AS low, max(x) AS high FROM x)
 SELECT CAST(least(39, floor((x - low) / ((high - low) / 40))) AS INT) AS bin, count(*) AS n FROM x, e GROUP BY 1""",
    "pair_length_prefilter": r"""WITH s AS (SELECT DISTINCT CAST(len(regexp_extract_all(text, '\S+')) AS INT) AS n FROM documents WHERE len(regexp_extract_all(text, '\S+')) > 0)
 SELECT a.n AS len_a, count(*) AS n_partners, min(b.n) AS least_b, max(b.n) AS most_b FROM s a JOIN s b ON a.n < b.n AND CAST(b.n AS DOUBLE) / a.n <= CAST(6 AS DOUBLE) / CAST(0.85 AS DOUBLE) GROUP BY a.n""",
    "boustrophedon_shards": f"""WITH {ctes("hits")}, r AS (SELECT seqname, start0, end0, name, sw_score, (row_number() OVER (PARTITION BY seqname ORDER BY start0, end0, name, sw_score) - 1) % 12 AS r FROM hits)
 SELECT seqname, start0, end0, name, sw_score, CAST(CASE WHEN r < 6 THEN r ELSE 11 - r END AS INT) AS shard FROM r""",
    "revcomp_gc_rotate": f"""WITH {ctes("loci")}, d AS (SELECT DISTINCT consensus, period, (period - 3) % 32 AS k FROM loci)
 SELECT consensus, period, translate(reverse(consensus), 'ACGT', 'TGCA') AS revcomp, round(len(regexp_replace(consensus, '[^GC]', '', 'g')) / 32.0, 6) AS gc_content,
 substr(consensus || consensus, k + 1, 32) AS rotated, consensus || consensus AS doubled FROM d""",
    "pair_seed_hash": f"""WITH {ctes("clusters", "edges")} SELECT label_a, label_b, CAST(CAST('0x' || substr(sha256('1' || chr(0) || label_a || chr(0) || label_b), 1, 16) AS UBIGINT) AS VARCHAR) AS seed FROM edges""",
    "family_letters": """WITH k AS (SELECT o_orderkey, o_orderkey % 18000 AS n FROM orders)
 SELECT o_orderkey, 'SAT171_' || CASE WHEN n < 26 THEN chr(CAST(97 + n AS INT)) WHEN n < 702 THEN chr(CAST(96 + n // 26 AS INT)) || chr(CAST(97 + n % 26 AS INT))
 ELSE chr(CAST(97 + (n - 702) // 676 AS INT)) || chr(CAST(97 + (n - 702) // 26 % 26 AS INT)) || chr(CAST(97 + (n - 702) % 26 AS INT)) END AS name FROM k""",
    "library_incremental_antijoin": """SELECT 's' || c_custkey AS sample, sha256('library') AS lib_sha256 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')""",
    "header_forward_fill": """SELECT conv_id, turn, md5(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS header_md5 FROM conversations""",
    "column_majority_consensus": f"""WITH {ctes("loci")}, c AS (SELECT entry_id, period, k, substr(consensus, CAST(k + 1 AS INT), 1) AS base FROM loci, range(32) AS t(k) WHERE (k + period) % 11 <> 0),
 v AS (SELECT entry_id, period, k, base, count(*) AS n FROM c GROUP BY ALL),
 w AS (SELECT *, row_number() OVER (PARTITION BY entry_id, period, k ORDER BY n DESC, md5(concat_ws(':', '1', entry_id, period, k, '0', base)) DESC) AS z FROM v)
 SELECT entry_id, period, string_agg(base, '' ORDER BY k) AS consensus, CAST(count(*) AS INT) AS consensus_length FROM w WHERE z = 1 GROUP BY ALL""",
    "infix_best_hit": f"""WITH {ctes("loci")}, d AS (SELECT DISTINCT consensus, translate(reverse(consensus), 'AC', 'CA') AS other FROM loci),
 s AS (SELECT consensus, other, z, a, levenshtein(substr(consensus, 1, 21), substr(other || other, CAST(a + 1 AS INT), CAST(z - a AS INT))) AS x FROM d, range(0, 65) AS p(z), range(0, 65) AS q(a) WHERE a <= z),
 b AS (SELECT *, row_number() OVER (PARTITION BY consensus, other ORDER BY x, z, a) AS n FROM s)
 SELECT consensus, other, CAST(x AS INT) AS distance, CAST(a AS INT) AS start, CAST(z AS INT) AS "end" FROM b WHERE n = 1""",
    "tile_pairs": f"""WITH RECURSIVE {ctes("loci")}, pool AS (SELECT consensus AS label, substr(consensus, 1, CAST(min(period) % 12 + 21 AS INT)) AS seq FROM loci GROUP BY consensus),
 pair AS (SELECT a.label AS label_a, b.label AS label_b, a.seq AS u, b.seq AS t, length(a.seq) AS m, length(b.seq) AS n, least(6, length(b.seq) // length(a.seq) + 2) AS most
  FROM pool a JOIN pool b ON length(a.seq) < length(b.seq) OR (length(a.seq) = length(b.seq) AND a.label < b.label)),
 st AS (SELECT label_a, label_b, side, u, m, n, most, CASE WHEN side = 0 THEN t ELSE translate(reverse(t), 'ACGT', 'TGCA') END AS ring, 0 AS taken, CAST(0 AS DOUBLE) AS shares, 0 AS copies, false AS done
   FROM pair, (VALUES (0), (1)) AS s(side)
  UNION ALL SELECT label_a, label_b, side, u, m, n, most, CASE WHEN stop THEN ring WHEN z <= n THEN left(ring, a) || repeat('N', z - a) || substr(ring, z + 1)
    ELSE repeat('N', z - n) || substr(ring, z - n + 1, a - (z - n)) || repeat('N', n - a) END, CASE WHEN stop THEN taken ELSE taken + z - a END,
   CASE WHEN stop THEN shares ELSE shares + (CAST(1 AS DOUBLE) - CAST(d AS DOUBLE) / m) END, CASE WHEN stop THEN copies ELSE copies + 1 END, stop
   FROM (SELECT *, CAST(1 AS DOUBLE) - CAST(d AS DOUBLE) / m < CAST(0.7 AS DOUBLE) AS stop FROM
    (SELECT *, CAST(best // 1000000 AS INT) AS d, CAST(best // 1000 % 1000 AS INT) AS z, CAST(best % 1000 AS INT) AS a FROM
     (SELECT *, list_min(list_transform(range(n * (2 * (m * 3 // 10) + 1)), lambda i: levenshtein(u, substr(ring || ring, CAST(i % n + 1 AS INT), CAST(m - m * 3 // 10 + i // n AS INT))) * 1000000
       + (i % n + m - m * 3 // 10 + i // n) * 1000 + i % n)) AS best FROM st WHERE NOT done AND copies < most AND taken < n)))),
 fin AS (SELECT label_a, label_b, side, m, n, least(CAST(taken AS DOUBLE) / n, 1) AS coverage, CASE WHEN copies > 0 THEN shares / copies END AS share, copies
   FROM st QUALIFY row_number() OVER (PARTITION BY label_a, label_b, side ORDER BY copies DESC, done DESC) = 1),
 got AS (SELECT * FROM fin QUALIFY row_number() OVER (PARTITION BY label_a, label_b ORDER BY coverage DESC, side) = 1),
 ok AS (SELECT *, coverage >= CAST(0.85 AS DOUBLE) AND share >= CAST(0.7 AS DOUBLE) AS good FROM got)
 SELECT label_a, label_b, CAST(m AS INT) AS len_a, CAST(n AS INT) AS len_b, round(CAST(n AS DOUBLE) / m, 6) AS length_ratio, round(coverage, 6) AS coverage, round(share, 6) AS mean_copy_identity,
  CAST(copies AS INT) AS n_copies_found, coalesce(good AND copies = 1, false) AS flag_similar, coalesce(good AND copies >= 2, false) AS flag_multiple_of FROM ok""",
}

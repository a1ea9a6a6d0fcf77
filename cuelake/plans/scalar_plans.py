"""Scalar expressions over whole tables."""

from pyspark.sql import functions as F

from cuelake import functions as fn
from cuelake.functions.base import idiv
from cuelake.operators import rules as rl
from cuelake.operators import scoring as sc
from cuelake.plans.interval_plans import STRICT
from cuelake.plans.registry import plan
from cuelake.plans.views import norm, tokens

CLOCK = "printf('%02d:%02d:%02d,%03d', {0}//3600000, {0}//60000%60, {0}//1000%60, {0}%1000)"


@plan("srt_to_ms_p1", """
, s AS (SELECT track_id, cue_id, CASE WHEN contains(text,'z') THEN printf('%02d:%02d:%02d,%03d', start_ms//3600000, 60 + start_ms//60000%60, start_ms//1000%60, start_ms%1000) ELSE """ + CLOCK.format("start_ms") + """ END AS stamp FROM cues)
SELECT track_id, cue_id, CASE WHEN regexp_full_match(stamp, '\\d{2,}:[0-5]\\d:[0-5]\\d,\\d{3}') THEN
 split_part(stamp,':',1)::BIGINT*3600000 + split_part(stamp,':',2)::BIGINT*60000 + split_part(split_part(stamp,':',3),',',1)::BIGINT*1000 + split_part(stamp,',',2)::BIGINT END AS ms FROM s""")
def srt_to_ms_p1(t):
    ms = F.col("start_ms")
    bad = F.format_string("%02d:%02d:%02d,%03d", idiv(ms, 3_600_000), 60 + idiv(ms, 60_000) % 60, idiv(ms, 1000) % 60, ms % 1000)
    stamp = F.when(F.contains("text", F.lit("z")), bad).otherwise(fn.ms_to_srt("start_ms"))
    return t.cues.select("track_id", "cue_id", fn.srt_to_ms(stamp).alias("ms"))


@plan("ms_to_srt_p2", f"SELECT track_id, cue_id, {CLOCK.format('start_ms')} AS first, {CLOCK.format('end_ms')} AS last FROM cues")
def ms_to_srt_p2(t):
    return t.cues.select("track_id", "cue_id", fn.ms_to_srt("start_ms").alias("first"), fn.ms_to_srt("end_ms").alias("last"))


@plan("clock_p3", """
SELECT track_id, cue_id, printf('%02d:%02d:%02d', start_ms//1000//3600, start_ms//1000//60%60, start_ms//1000%60) AS coarse,
 printf('%02d:%02d:%02d.%03d', start_ms//3600000, start_ms//60000%60, start_ms//1000%60, start_ms%1000) AS precise FROM cues""")
def clock_p3(t):
    seconds = F.col("start_ms") / F.lit(1000.0)
    return t.cues.select("track_id", "cue_id", fn.clock(seconds).alias("coarse"), fn.clock(seconds, ms=True).alias("precise"))


@plan("norm_text_p4", f"SELECT doc_id, {norm()} AS norm FROM documents")
def norm_text_p4(t):
    return t.raw("documents").select("doc_id", fn.norm_text("text").alias("norm"))


@plan("letter_tokens_p5", f"SELECT doc_id, len({tokens()})::BIGINT AS n, array_to_string({tokens()}, '|') AS tokens FROM documents")
def letter_tokens_p5(t):
    words = fn.letter_tokens("text")
    return t.raw("documents").select("doc_id", F.size(words).cast("bigint").alias("n"), F.array_join(words, "|").alias("tokens"))


TR = "lower(translate({0},'Iİ','ıi'))"


@plan("norm_turkish_p6", f"SELECT doc_id, trim(regexp_replace(regexp_replace({TR.format('text')}, '[^\\p{{L}}\\p{{N}}\\s'']', '', 'g'), '\\s+', ' ', 'g')) AS norm FROM documents")
def norm_turkish_p6(t):
    return t.raw("documents").select("doc_id", fn.norm_turkish("text").alias("norm"))


@plan("tr_key_p7", f"SELECT doc_id, regexp_replace({TR.format('text')}, '[^a-zçğıöşü0-9]', '', 'g') AS key FROM documents")
def tr_key_p7(t):
    return t.raw("documents").select("doc_id", fn.tr_key("text").alias("key"))


@plan("align_text_p8", "SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS plain FROM documents")
def align_text_p8(t):
    return t.raw("documents").select("doc_id", fn.align_text("text").alias("plain"))


@plan("reading_speed_p10", "SELECT track_id, cue_id, end_ms-start_ms AS duration_ms, round(length(replace(text, chr(10), '')) * 1000.0::DOUBLE / (end_ms-start_ms), 6) AS cps FROM target")
def reading_speed_p10(t):
    return t.target.select("track_id", "cue_id", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"), F.round(fn.cps("text", "start_ms", "end_ms"), 6).alias("cps"))


def set_hash_sql(column):
    part = lambda at: f"sum(('0x' || substr({column}, {at}, 15))::BIGINT)::VARCHAR"
    return f"sha256(concat_ws(':', count(*)::VARCHAR, {part(1)}, {part(16)}, {part(31)}, {part(46)}))"


ROW_SHA = "sha256(concat_ws(chr(31), c.start_ms, c.end_ms, c.text))"
INTERVAL = f"""isha AS (SELECT h.track_id, h.start_ms, h.end_ms, CASE WHEN count(c.cue_id)=0 THEN sha256('0:0:0:0:0') ELSE {set_hash_sql(ROW_SHA)} END AS interval_sha
 FROM heard h LEFT JOIN cues c ON c.track_id=h.track_id AND c.start_ms < h.end_ms AND c.end_ms > h.start_ms GROUP BY 1, 2, 3)"""


@plan("interval_hash_p14", f", {INTERVAL} SELECT * FROM isha")
def interval_hash_p14(t):
    spans = t.heard.select("track_id", "start_ms", "end_ms", F.col("start_ms").alias("span"))
    return rl.interval_sha(t.cues, spans, ["span"]).drop("span")


@plan("fingerprint_p15", "SELECT doc_id, sha256(concat_ws(chr(31), 'lang=' || lang, 'n_chars=' || n_chars, 'text=' || text)) AS sha FROM documents")
def fingerprint_p15(t):
    return t.raw("documents").select("doc_id", fn.fingerprint(text="text", lang="lang", n_chars="n_chars").alias("sha"))


def loop_sql(repeats):
    same = lambda w: " AND ".join(f"w[i:i+{w - 1}] = w[i+{w * r}:i+{w * r + w - 1}]" for r in range(1, repeats))
    any_at = lambda w: f"coalesce(list_bool_or(list_transform(range(1, len(w)-{w * repeats}+2), lambda i: {same(w)})), false)"
    return " OR ".join(any_at(w) for w in range(1, 5))


@plan("phrase_loop_p16", f"SELECT track_id, cue_id, {loop_sql(2)} AS twice, {loop_sql(4)} AS loop FROM word_lists")
def phrase_loop_p16(t):
    rows = t.cues.withColumn("w", fn.letter_tokens("text"))
    return rows.select("track_id", "cue_id", fn.has_loop("w", 4, 2).alias("twice"), fn.has_loop("w").alias("loop"))


@plan("degenerate_p17", f"""SELECT track_id, cue_id, coalesce(list_bool_or(list_transform(w, lambda x: length(x) > 40)), false) OR {loop_sql(4)} OR
 (len(w) >= 8 AND list_max(list_transform(list_distinct(w), lambda x: len(list_filter(w, lambda y: y = x)))) > 0.3 * len(w)) AS degenerate FROM word_lists""")
def degenerate_p17(t):
    return t.cues.select("track_id", "cue_id", fn.is_degenerate(fn.letter_tokens("text"), share=0.3).alias("degenerate"))


@plan("valid_tags_p18", "SELECT doc_id, regexp_full_match(lang, '[a-z]{2,3}(-[A-Za-z0-9]{2,8})*') AS lang_ok, regexp_full_match(source || '#' || lang, '[A-Za-z0-9][A-Za-z0-9._-]*') AS id_ok, regexp_full_match(source, '[A-Za-z0-9][A-Za-z0-9._-]*') AS source_ok FROM documents")
def valid_tags_p18(t):
    return t.raw("documents").select("doc_id", fn.valid_lang("lang").alias("lang_ok"), fn.valid_episode(F.concat("source", F.lit("#"), "lang")).alias("id_ok"), fn.valid_episode("source").alias("source_ok"))


@plan("absolute_episode_p19", "SELECT doc_id, doc_id % 3 + 1 AS season, doc_id % 40 + 1 AS episode, [0, 20, 61][doc_id % 3 + 1]::BIGINT + doc_id % 40 + 1 AS absolute FROM documents")
def absolute_episode_p19(t):
    rows = t.raw("documents").select("doc_id", (F.col("doc_id") % 3 + 1).alias("season"), (F.col("doc_id") % 40 + 1).alias("episode"))
    return rows.withColumn("absolute", fn.absolute_episode("season", "episode"))


# Customer-entered forms of nation names: one letter dropped, or an ending put on.
def name_pairs(t):
    nation = t.raw("nation").select(F.col("n_nationkey").alias("k"), "n_name")
    supplier = t.raw("supplier").select(F.col("s_suppkey").alias("pair_id"), F.col("s_nationkey").alias("k"))
    joined = supplier.join(nation, "k")
    old = F.concat(F.expr("substr(n_name, 1, cast(pair_id % 5 as int))"), F.expr("substr(n_name, cast(pair_id % 5 + 2 as int))"))
    new = F.when(F.col("pair_id") % 2 == 0, F.col("n_name")).otherwise(F.concat("n_name", F.lit("'da")))
    return joined.select("pair_id", F.when(F.col("pair_id") % 3 == 0, F.concat("n_name", F.lit("da"))).otherwise(old).alias("old"), new.alias("new"))


NAME_PAIRS = """np AS (SELECT s_suppkey AS pair_id, CASE WHEN s_suppkey % 3 = 0 THEN n_name || 'da' ELSE substr(n_name, 1, s_suppkey % 5) || substr(n_name, s_suppkey % 5 + 2) END AS old,
 CASE WHEN s_suppkey % 2 = 0 THEN n_name ELSE n_name || '''da' END AS new FROM supplier JOIN nation ON n_nationkey = s_nationkey),
kp AS (SELECT pair_id, old, new, regexp_replace(lower(translate(old,'Iİ','ıi')), '[^a-zçğıöşü0-9]', '', 'g') AS o, regexp_replace(lower(translate(new,'Iİ','ıi')), '[^a-zçğıöşü0-9]', '', 'g') AS n FROM np),
nk AS (SELECT DISTINCT regexp_replace(lower(translate(n_name,'Iİ','ıi')), '[^a-zçğıöşü0-9]', '', 'g') AS k FROM nation)"""


@plan("name_repairs_p20_p21", f""", {NAME_PAIRS}
SELECT pair_id, old, new,
 coalesce(bool_or(nk.k = n AND levenshtein(translate(o,'ı','i'), translate(k,'ı','i')) <= CASE WHEN length(k) <= 5 THEN 1 ELSE 2 END AND levenshtein(translate(o,'ı','i'), translate(k,'ı','i')) <= length(k) * 0.34), false) AS near_name,
 coalesce(bool_or(o = n AND starts_with(n, k) AND length(n)-length(k) BETWEEN 0 AND 5), false) AS name_suffix FROM kp CROSS JOIN nk GROUP BY 1, 2, 3""")
def name_repairs_p20_p21(t):
    return sc.name_repairs(name_pairs(t), t.raw("nation").select(F.col("n_name").alias("name")))


@plan("gate_counts_a26")
def gate_counts_a26(t):
    edits = name_pairs(t).select(F.col("pair_id").alias("edit_id"), F.concat(F.lit("geldi "), "old").alias("old"), F.concat(F.lit("Geldi "), "new").alias("new"))
    return sc.gate_counts(edits, t.raw("nation").select(F.col("n_name").alias("name")))


@plan("fits_layout_p22", """
/*recursive*/, f AS (SELECT track_id, cue_id, trim(replace(replace(text, chr(13), ' '), chr(10), ' ')) AS x, (end_ms-start_ms)*20//1000 AS budget FROM cues),
v AS (SELECT *, list_filter(regexp_split_to_array(x, '\\s+'), lambda q: q <> '') AS q FROM f),
r AS (SELECT *, list_reduce(list_prepend({'n': 0::BIGINT, 'l': 0::BIGINT, 'm': 0::BIGINT}, list_transform(q, lambda y: {'n': -1::BIGINT, 'l': length(y)::BIGINT, 'm': 0::BIGINT})),
 lambda a, y: {'n': CASE WHEN a.n = 0 OR a.l + 1 + y.l > 42 THEN a.n + 1 ELSE a.n END, 'l': CASE WHEN a.n = 0 OR a.l + 1 + y.l > 42 THEN y.l ELSE a.l + 1 + y.l END,
  'm': greatest(a.m, CASE WHEN a.n = 0 OR a.l + 1 + y.l > 42 THEN y.l ELSE a.l + 1 + y.l END)}) AS z FROM v)
SELECT track_id, cue_id, z.n AS lines, x <> '' AND NOT contains(x, '<') AND NOT contains(x, '>') AND length(x) <= budget AND z.n <= 2 AND z.m <= 42 AS fits FROM r""")
def fits_layout_p22(t):
    flat = F.trim(F.regexp_replace("text", r"[\r\n]", " "))
    rows = t.cues.withColumn("shape", fn.wrapped_lines(flat))
    return rows.select("track_id", "cue_id", F.col("shape.lines").cast("bigint").alias("lines"), fn.fits_layout("text", fn.char_budget("start_ms", "end_ms"), shape="shape").alias("fits"))


@plan("char_budget_p23", "SELECT track_id, cue_id, (end_ms-start_ms)*20//1000 AS budget FROM target WHERE length(replace(text, chr(10), ' ')) * 1000 > 20 * (end_ms-start_ms)")
def char_budget_p23(t):
    return fn.fast_cues(t.target, 20).select("track_id", "cue_id", "budget")


@plan("zero_duration_p24", "SELECT track_id, cue_id, start_ms, CASE WHEN contains(text,'q') THEN start_ms + 1 ELSE end_ms END AS end_ms, CASE WHEN contains(text,'q') THEN start_ms ELSE end_ms END AS raw_end_ms FROM cues")
def zero_duration_p24(t):
    broken = t.cues.withColumn("end_ms", F.when(F.contains("text", F.lit("q")), F.col("start_ms")).otherwise(F.col("end_ms")))
    return fn.fix_zero_duration(broken).drop("text")


@plan("rule_check_p25", """
SELECT track_id, cue_id, unnest(list_filter([CASE WHEN NOT end_ms-start_ms BETWEEN 500 AND 20000 THEN 'duration' END, CASE WHEN NOT length(text) <= 300 THEN 'length' END, CASE WHEN contains(text, '@') THEN 'address' END], lambda x: x IS NOT NULL)) AS rule FROM cues""")
def rule_check_p25(t):
    return rl.check_rules(t.cues, ["track_id", "cue_id"], {
        "duration": (F.col("end_ms") - F.col("start_ms")).between(500, 20_000), "length": F.length("text") <= 300,
        "address": ~F.contains("text", F.lit("@"))})


@plan("start_policy_p26", """
, a AS (SELECT c.track_id, c.cue_id, c.start_ms, c.end_ms, c.start_ms + (c.cue_id % 9) * 400 - 400 AS al FROM cues c),
u AS (SELECT *, CASE WHEN al >= end_ms THEN start_ms ELSE al END AS us, CASE WHEN abs(al-start_ms) < 1000 THEN start_ms ELSE al END AS mv FROM a)
SELECT track_id, cue_id, CASE WHEN us-start_ms >= 1000 THEN greatest(start_ms, us-500) ELSE start_ms END AS final_start, CASE WHEN mv >= end_ms THEN start_ms ELSE mv END AS first_pass, abs(al-start_ms) >= 2000 AS flagged FROM u""")
def start_policy_p26(t):
    rows = t.cues.withColumn("al", F.col("start_ms") + (F.col("cue_id") % 9) * 400 - 400)
    return rows.select("track_id", "cue_id", fn.start_policy("start_ms", "end_ms", "al").alias("final_start"),
                       fn.aligned_start("start_ms", "end_ms", "al").alias("first_pass"), (F.abs(F.col("al") - F.col("start_ms")) >= 2000).alias("flagged"))


@plan("unit_ids_p27", "SELECT track_id, cue_id, printf('u%06d-%09d', cue_id, start_ms) AS unit_id, printf('t%06d-%09d', cue_id, start_ms) AS translation_id FROM cues")
def unit_ids_p27(t):
    return t.cues.select("track_id", "cue_id", fn.unit_id("cue_id", "start_ms").alias("unit_id"), fn.unit_id("cue_id", "start_ms", "t").alias("translation_id"))


@plan("track_key_p28", "SELECT page_id, regexp_extract(url, '([^/?]+)(\\?[^/]*)?$', 1) AS key FROM pages")
def track_key_p28(t):
    return t.raw("pages").select("page_id", fn.track_key("url").alias("key"))


@plan("overlap_predicate_p12", f"SELECT a.track_id, a.cue_id, count(b.cue_id) AS n FROM cues a LEFT JOIN target b ON a.track_id=b.track_id AND a.cue_id=b.cue_id AND {STRICT} GROUP BY 1, 2")
def overlap_predicate_p12(t):
    other = t.target.select("track_id", "cue_id", F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    joined = t.cues.join(other, ["track_id", "cue_id"], "left")
    hit = F.coalesce(fn.intersects("start_ms", "end_ms", "r_start", "r_end"), F.lit(False))
    return joined.select("track_id", "cue_id", hit.cast("bigint").alias("n"))

"""Generated tables, candidates, texts and clips, made from the rows of the given tables."""

from pyspark.sql import functions as F

from corpusgauge.bindings.registry import query
from corpusgauge.functions.ids import sha_id, sha_id_63
from corpusgauge.functions.text import word_error_rate
from corpusgauge.operators import generate, ordering, prepare

SHA = "('0x' || substr(sha256({}), 1, 15))::bigint"


WIDE = "((('0x' || substr(sha256({}), 1, 16))::ubigint) >> 1)::bigint"
PARTS = "source || $$|$$ || lang || $$|$$ || doc_id"


@query(f"select doc_id, {SHA.format(PARTS)} row_id, {WIDE.format(PARTS)} wide_id from documents")
def det_id(t):
    parts = F.col("source"), F.col("lang"), F.col("doc_id")
    return t.documents.select("doc_id", sha_id(*parts).alias("row_id"), sha_id_63(*parts).alias("wide_id"))


IDENTITIES = f"""i as (select c_custkey, {SHA.format("'identity|' || c_custkey")} identity_id, {SHA.format("'seed|' || c_custkey")} seed, 'n' || c_nationkey source_subject,
 case when {SHA.format("'subject|n' || c_nationkey")} % 10000 < 1000 then 'val' else 'train' end split from customer)"""


def people(t):
    return generate.identities(t.customer, F.col("c_custkey"), F.concat(F.lit("n"), "c_nationkey"), 0.1)


@query(f"""with {IDENTITIES}, p(phenotype_id, name) as (values (0, 'gender'), (1, 'age'), (2, 'muscle'), (3, 'weight'), (4, 'height'), (5, 'proportions'))
 select identity_id, seed, source_subject, split, name, round({SHA.format("'phenotype|' || seed || '|' || phenotype_id")} / 1152921504606846976.0::double, 9) as value from i, p""")
def gen_identities(t):
    a = generate.attributes(people(t))
    return a.select("identity_id", "seed", "source_subject", "split", "name", F.round("value", 9).alias("value"))


@query(f"""with {IDENTITIES}, s as (select {SHA.format("'scene|' || identity_id")} scene_id, identity_id, {SHA.format("'pose|' || identity_id")} % (select count(*) from part) pose_id,
  {SHA.format("'environment|' || identity_id")} % 12 env_id, split from i)
 select scene_id, identity_id, pose_id, p_name pose, env_id, split, v::int view_index from s join part on p_partkey = pose_id, unnest(range(0, 3)) u(v)""")
def scene_views(t):
    n_poses = t.part.agg(F.count(F.lit(1))).scalar()
    s = generate.scenes(people(t), n_poses, 12)
    posed = s.join(t.part.select(F.col("p_partkey").alias("pose_id"), F.col("p_name").alias("pose")), "pose_id")
    return generate.with_rows(posed, [(0,), (1,), (2,)], "view_index").select(
        "scene_id", "identity_id", "pose_id", "pose", "env_id", "split", "view_index")


# A specification of our own: edit, kind, parameter, amount, wrong part. No edit is called "missing".
EDITS = (
    ("lift", "limb", "angle", 30.0, "turn"), ("turn", "limb", "angle", -45.0, "lift"), ("grow", "shape", "size", 0.25, "shrink"),
    ("shrink", "shape", "size", -0.2, "grow"), ("paint", "surface", "hue", 0.5, "missing"),
)
GRADES = ((1, 1.0, "none"), (2, 0.6, "none"), (3, 1.0, "part"), (4, 0.8, "subject"))
EDIT_ROWS = ", ".join(str(e) for e in EDITS)


@query(f"""with e(edit, kind, parameter, amount, wrong) as (values {EDIT_ROWS}), g("rank", scale, err) as (values {', '.join(str(g) for g in GRADES)}),
 c as (select s_suppkey, e.edit, "rank", case when err = 'part' then e.wrong else e.edit end target, scale::double scale, err = 'subject' wrong_subject from supplier, g, e)
 select s_suppkey, c.edit, "rank", target, w.kind target_kind, w.parameter, round(w.amount * scale, 6)::double amount, scale, wrong_subject, w.edit is null problem from c left join e w on w.edit = target""")
def graded_candidates(t):
    made = generate.graded_candidates(t.supplier, "s_suppkey", EDITS, GRADES)
    return made.withColumn("amount", F.round("amount", 6))


# A specification of our own: rank, kind, severity, pitch, tempo, voice and text source.
VOICE_RANKS = (
    (1, "same", 1.0, 0.0, 1.0, "self", "self"), (2, "higher", 0.8, 3.0, 1.0, "self", "self"), (3, "lower", 0.8, -3.0, 1.0, "self", "self"),
    (4, "hasty", 0.6, 0.0, 1.25, "self", "self"), (5, "other words", 0.4, 0.0, 1.0, "self", "next"),
    (6, "set words", 0.4, 0.0, 1.0, "self", "fixed"), (7, "other voice", 0.2, 0.0, 1.0, "pool", "self"),
)
SET_WORDS = "One two three four five."
VOICES = ", ".join(str(v) for v in VOICE_RANKS)


@query(f"""with v("rank", kind, severity, pitch, tempo, voice_source, text_source) as (values {VOICES}),
 c as (select conv_id, turn, text said, coalesce(lead(text) over (order by conv_id, turn), first(text) over (order by conv_id, turn)) nxt, row_number() over (order by conv_id, turn) - 1 i from conversations),
 p as (select s_name vo, row_number() over (order by s_name) - 1 slot, count(*) over () n from supplier)
 select conv_id, turn, "rank", kind, severity::double severity, pitch::double pitch, tempo::double tempo, case when voice_source = 'pool' then vo else 'self' end voice,
 case text_source when 'next' then nxt when 'fixed' then '{SET_WORDS}' else said end target_text from v, c join p on slot = i % n""")
def candidate_text(t):
    return generate.voice_candidates(t.conversations, ["conv_id", "turn"], "text", VOICE_RANKS, SET_WORDS, t.supplier, "s_name")


RANK_KINDS = tuple((r, kind) for r, kind, *_ in VOICE_RANKS)


@query(f"""with k("rank", kind) as (values {', '.join(str(k) for k in RANK_KINDS)}) select l_orderkey, l_partkey, l_linenumber, kind candidate_kind from lineitem join k on "rank" = l_linenumber""")
def rank_map(t):
    kinds = prepare.literal_rows(t.spark, RANK_KINDS, "l_linenumber candidate_kind")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    return lines.join(F.broadcast(kinds), "l_linenumber").select("l_orderkey", "l_partkey", "l_linenumber", "candidate_kind")


BLANK = r"[\s\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def words_of(column: str) -> str:
    return f"list_filter(string_split_regex(lower({column}), '{BLANK}'), lambda x: x <> '')"


@query(f"""with p as (select conv_id, turn, text said, lead(text) over (partition by conv_id order by turn) reply from conversations),
 w as (select conv_id, turn, {words_of('said')} r, {words_of('reply')} h from p where said is not null and reply is not null),
 d as (select *, list_reduce(h, lambda above, word: list_reduce(r, lambda line, x: list_append(line,
   least(above[len(line) + 1] + 1, line[-1] + 1, above[len(line)] + (x <> word)::int)), [above[1] + 1]), range(0, len(r) + 1)::int[]) last from w)
 select conv_id, turn, round(case when len(r) > 0 then last[-1] / len(r) when len(h) > 0 then 1 else 0 end, 6) wer from d""")
def wer(t):
    """Each turn against the next of its conversation, on whole texts."""
    turns = t.conversations.select("conv_id", "turn")
    pairs = ordering.neighbour(turns, ["turn"], F.col("turn"), "after", ["conv_id"]).where("after is not null")
    reply = t.conversations.select("conv_id", F.col("turn").alias("after"), F.col("text").alias("reply"))
    full = pairs.join(t.conversations.select("conv_id", "turn", "text"), ["conv_id", "turn"]).join(reply, ["conv_id", "after"])
    return full.where("text is not null and reply is not null").select(
        "conv_id", "turn", F.round(word_error_rate(F.col("text"), F.col("reply")), 6).alias("wer"))


CLIP_HEAD = """HIERARCHY
ROOT hip
{
  OFFSET 0 0 0
  CHANNELS 5 Xposition Yposition Zposition Zrotation Yrotation
  JOINT arm
  {
    OFFSET 0 1 0
    CHANNELS 3 Yrotation Xrotation Zrotation
    End Site
    {
      OFFSET 0 1 0
    }
  }
}
MOTION
"""


@query("""with f as (select vec_id, label, i, embedding[8 * i + 1 : 8 * i + 8]::double[] v from embeddings, unnest(range(0, 8)) u(i) where label <> 3)
 select vec_id clip, i::int frame, 'hip' joint, null parent, 0.0::double ox, 0.0::double oy, 0.0::double oz, 'zy' rotation_order, v[1] tx, v[2] ty, v[3] tz, 0 rx, v[5] ry, v[4] rz, null problem from f
 union all select vec_id, i, 'arm', 'hip', 0, 1, 0, 'yxz', 0, 0, 0, v[7], v[6], v[8], null from f
 union all select vec_id, null, null, null, null, null, null, null, null, null, null, null, null, null, 'header says 9 frames, data holds 8' from embeddings where label = 3""")
def clip_ingest(t):
    """Every vector is written out as a clip of 8 frames; those of one label claim 9."""
    from corpusgauge.sources.clips import ingest

    n = F.when(F.col("label") == 3, 9).otherwise(8)
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.array_join(
        F.transform(F.slice("embedding", i * 8 + 1, F.lit(8)), lambda v: v.cast("double").cast("string")), " "))
    text = F.concat(F.lit(CLIP_HEAD), F.lit("Frames: "), n, F.lit("\nFrame Time: 0.0333\n"), F.array_join(rows, "\n"), F.lit("\n"))
    good, bad = ingest(t.embeddings.select(F.col("vec_id").alias("clip"), text.alias("text")), "clip", "text")
    return good.unionByName(bad, allowMissingColumns=True)

"""The task-feature ontology, its upward closure, and concepts found in texts and for features.

On the wire 0 is PRESENT and 1 is ABSENT; everything here keeps that, so presence joins by ``min``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip, tokens
from ..shared import written

# Features by their direct parents.
CHILDREN = {
    (): ["language", "processing", "task_structure"],
    ("language",): ["phonetics/phonology", "morphology", "syntax", "semantics", "pragmatics/discourse"],
    ("phonetics/phonology",): [
        "prosody", "phoneme_discrimination", "phoneme_categorization", "phonological_awareness", "phonological_working_memory", "phonological_rule_application",
        "tone_perception/production", "vowel_formant_manipulation", "consonant_place_manner", "stress_accent_detection", "intonation_contour_perception",
    ],
    ("prosody", "phonetics/phonology"): ["rhythm/metrical_structure"],
    ("rhythm/metrical_structure",): ["rhythm_class_judgement", "metrical_foot_structure", "poetic_meter_detection", "pvi_based_rhythm_metric"],
    ("rhythm/metrical_structure", "processing"): ["speech_rate_normalization", "beat_entrainment/synchrony"],
    ("morphology",): ["morphological_decomposition", "morphological_productivity", "derivational_morphology", "inflectional_morphology", "compound_processing"],
    ("syntax",): [
        "syntactic_parsing", "grammaticality_judgement", "sentence_comprehension", "sentence_production", "agreement_processing", "filler_gap_dependency",
        "relative_clause_processing", "wh_question_processing", "garden_path/reanalysis",
    ],
    ("semantics",): [
        "lexical_semantics", "compositionality", "semantic_relations/taxonomic", "semantic_relations/thematic", "entailment/implicature_sensitivity", "metaphor/figurative",
        "semantic_anomaly_detection",
    ],
    ("pragmatics/discourse",): ["reference/anaphora", "coherence/narrative", "speech_acts/implicature", "information_structure"],
    ("processing",): [
        "comprehension", "production", "prediction/anticipation", "working_memory/maintenance", "parsing/structure_building", "semantic_integration", "monitoring/error_detection",
        "executive_control", "attention_selective", "attention_divided", "attention_sustained", "task_switching", "inhibitory_control", "entrainment/temporal_alignment",
    ],
    ("task_structure",): [
        "input_audio", "input_visual", "input_crossmodal", "output_motor_response", "time_pressure", "materials_letter/grapheme", "materials_morpheme", "materials_nonword", "materials_word",
        "materials_phrase", "materials_sentence", "materials_paragraph/narrative", "picture/object_naming", "semantic_priming_sensitivity", "semantic_plausibility_judgement",
        "syntactic_violation_detection", "prosody_perception", "prosody_production",
    ],
}
# The parents whose leaves are representational features.
REPRESENTATIONAL = ("language", "phonetics/phonology", "morphology", "syntax", "semantics", "pragmatics/discourse", "prosody", "rhythm/metrical_structure")

NODES = [n for names in CHILDREN.values() for n in names]
EDGES = [(n, p) for parents, names in CHILDREN.items() for n in names for p in parents]
LEAVES = [n for n in NODES if n not in {p for _, p in EDGES}]


def ancestors() -> list[tuple[str, str]]:
    """(node, ancestor) pairs, the node itself not among them: a fixed table, as the ontology is."""
    up: dict[str, set[str]] = {}
    for parents, names in CHILDREN.items():
        for n in names:
            up.setdefault(n, set()).update(parents)
    grown = True
    while grown:
        grown = False
        for n, seen in up.items():
            more = set().union(*[up[a] for a in seen]) - seen if seen else set()
            if more:
                seen |= more
                grown = True
    return sorted((n, a) for n, seen in up.items() for a in seen)


def schema_leaves(kind: str) -> list[str]:
    """Leaves that the representational, processing or design question asks for."""
    wanted = {"representational": REPRESENTATIONAL, "processing": ("processing",), "design": ("task_structure",)}[kind]
    return [n for n in LEAVES if any(p in wanted for c, p in EDGES if c == n)]


def closure(assigned: DataFrame, task: str = "task_id") -> DataFrame:
    """(task, feature, value) for every node: 0 where the node or any below it is 0, else what it was
    assigned, 1 by default.

    One join with the 138 pairs and one aggregation by task, which fills the missing nodes too.
    """
    spark = assigned.sparkSession
    up = spark.createDataFrame(ancestors(), "feature string, node string")  # a fixed table: 138 rows
    raised = assigned.where("value = 0").join(F.broadcast(up), "feature").select(task, F.col("node").alias("feature"), F.col("value"))
    known = assigned.select(task, "feature", "value").unionByName(raised).groupBy(task, "feature").agg(F.min("value").alias("value"))
    per = known.groupBy(task).agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("known"))
    nodes = F.array(*[F.lit(n) for n in NODES])
    every = F.array_union(nodes, F.map_keys("known"))
    return per.select(task, F.explode(F.transform(every, lambda n: F.struct(n.alias("feature"), F.coalesce(F.try_element_at("known", n), F.lit(1)).alias("value")))).alias("x")).select(task, "x.*")


def closure_counts(closed: DataFrame, task: str = "task_id") -> DataFrame:
    return closed.groupBy(task).agg(F.count("*").alias("total"), F.count_if(F.col("value") == 0).alias("present"), F.count_if(F.col("value") == 1).alias("absent"))


def merge_features(*layers: DataFrame, task: str = "task_id") -> DataFrame:
    """(task, feature, value) of several layers; later ones win."""
    rows = [df.select(task, "feature", "value", F.lit(i).alias("layer")) for i, df in enumerate(layers)]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.groupBy(task, "feature").agg(F.max_by("value", "layer").alias("value"))


def normalize_flag(answer: Column | str) -> Column:
    """A model's answer (JSON scalar as text) as 0 or 1.

    What reads as an integer is one: 0 is present, all others are absent, so true (1) is absent. Else
    words tell; missing and unknown ones are absent.
    """
    x = F.col(answer) if isinstance(answer, str) else answer
    bare = F.lower(strip(F.regexp_replace(x, '^"|"$', "")))
    number = F.when(x == "true", 1.0).when(x == "false", 0.0).when(bare.rlike(r"^[+-]?\d+$") | ~x.startswith('"'), bare.try_cast("double"))
    whole = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number))
    # Words for present; all other words are absent.
    return F.when(whole.isNotNull(), F.when(whole == 0, 0).otherwise(1)).when(bare.isin("present", "yes", "true", "y"), 0).otherwise(1)


def flat_features(closed: DataFrame, task: str = "task_id") -> DataFrame:
    """A row per task with a column for each node."""
    return closed.groupBy(task).pivot("feature", NODES).agg(F.min("value"))


#: Characters by which texts and terms are joined.
GRAM = 4
#: Bytes that words or terms of concepts take at most (100 a row besides the words) if all tasks are to have them.
SENT = 8 << 20


def met(rows: DataFrame, side: DataFrame, by: str) -> DataFrame:
    """``rows`` of texts joined with the words or terms of concepts. These go to all tasks if they are measured to
    be few, else both sides are dealt by key. The planner would go by the size of compressed files, in which
    the texts' words and runs look small, and gather those in the driver."""
    size = side.agg(F.sum(F.octet_length(by) + 100)).first()[0] or 0
    return rows.join(side.hint("broadcast" if size <= SENT else "shuffle_merge"), by)


def concept_scores(texts: DataFrame, concepts: DataFrame, key: str = "text_id", text: str = "text") -> DataFrame:
    """(key, concept_id, relevance_score) above 0: 2 if the name is in the text, 1 for each word of
    the name of over three letters that is, 0.5 for each word that text and definitions share; 10 at
    most.

    Shared words meet by an equi-join. So do texts and the terms that may be in them: by a term's first
    four characters (all of a shorter one) among the text's runs of so many, which the text then confirms.
    Concepts are written first, so that they are computed once; whatever holds texts is never broadcast.
    """
    own = texts.select(key, F.lower(text).alias("low"))
    named = written(concepts.select("concept_id", F.lower("name").alias("name"), F.lower("definitions").alias("defs")), "concepts")
    shared = met(own.select(key, F.explode(F.array_distinct(tokens("low"))).alias("word")), named.select("concept_id", F.explode(F.array_distinct(tokens("defs"))).alias("word")), "word")
    shared = shared.groupBy(key, "concept_id").agg((F.count("*") * 0.5).alias("points"))
    words = named.select("concept_id", F.explode(tokens("name")).alias("term")).where(F.length("term") > 3).withColumn("points", F.lit(1.0))
    terms = words.unionAll(named.select("concept_id", F.col("name").alias("term"), F.lit(2.0).alias("points"))).groupBy("concept_id", "term").agg(F.sum("points").alias("points"))
    begun = terms.where("term IS NOT NULL").select("term", F.left("term", F.lit(GRAM)).alias("gram")).distinct()
    sizes = [r.n for r in begun.select(F.length("gram").alias("n")).distinct().collect()]  # GRAM + 1 at most

    def runs(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length("low") - (n - 1), F.lit(1))), lambda i: F.substring("low", i, F.lit(n)))

    grams = F.array_distinct(F.flatten(F.array(*[runs(n) for n in sizes]))) if sizes else F.array(F.lit(""))
    near = met(own.select(key, F.explode(grams).alias("gram")), begun, "gram").select(key, "term")
    held = own.join(near.hint("shuffle_merge"), key).where(F.col("low").contains(F.col("term"))).select(key, "term")
    held = met(held, terms, "term").select(key, "concept_id", "points")
    return shared.unionByName(held).groupBy(key, "concept_id").agg(F.least(F.sum("points"), F.lit(10.0)).alias("relevance_score"))


def feature_concepts(features: DataFrame, concepts: DataFrame, task: str = "task_id", top: int = 5, least: float = 0.3) -> DataFrame:
    """(task, feature, rank, concept_id, relevance) for present features: the share of the feature's
    words that a concept's name or definitions have, over ``least``; ties in the concepts' order
    (``concept_no``)."""
    present = features.where("value = 0")
    wanted = present.select("feature").distinct().withColumn("words", F.array_distinct(tokens(F.translate(F.lower("feature"), "/_", "  "))))
    said = concepts.select("concept_id", "concept_no", F.explode(F.array_union(tokens(F.lower("name")), tokens(F.lower("definitions")))).alias("word"))
    met = wanted.select("feature", F.size("words").alias("n"), F.explode("words").alias("word")).join(said, "word").groupBy("feature", "n", "concept_id", "concept_no").count()
    met = met.withColumn("relevance", F.col("count") / F.greatest("n", F.lit(1))).where(F.col("relevance") > least)
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("relevance"), "concept_no"))
    best = met.withColumn("rank", rank).where(F.col("rank") <= top).select("feature", "rank", "concept_id", "relevance")
    return present.select(task, "feature").join(best, "feature").select(task, "feature", "rank", "concept_id", "relevance")


def concept_definitions(raw: DataFrame, kind: str = "ctp_C6") -> DataFrame:
    """(concept_id, name, definitions, cognitive_category) of one class, from (id, name, class_id,
    class_name, definitions array): different definitions in order, joined."""
    return raw.where(F.col("class_id") == kind).select(
        F.col("id").alias("concept_id"), "name", F.array_join(F.array_distinct(F.filter("definitions", lambda d: strip(d) != "")), "\n---\n").alias("definitions"), F.col("class_name").alias("cognitive_category")
    )


def edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EDGES, "child string, parent string")

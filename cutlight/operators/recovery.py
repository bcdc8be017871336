"""Observations recovered from what older rounds of a model have left behind, without asking again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Beginnings of words that show what is seen, each group one pattern.
DIALOGUE = ("convers", "habla", "hablando", "escuch", "interlocutor", "talking", "discusi")
INDEPENDENT = (
    "teléfono", "telefono", "comiendo", "escrib", "leer", "examin", "oler", "cajón", "cajon", "volante", "conduce", "camina", "alej", "lleva", "sostiene", "abraza", "apoya", "tose", "escupe", "maquill", "bus", "autobús", "autobus",
)
MOVEMENT = ("camina", "alej", "marcha", "desplaza", "entra", "sale", "lleva")
STATE = ("recost", "cama", "dorm", "descansa", "repos", "ojos cerrados")
PHYSICAL = ("abraza", "apoya", "examen médico", "examen medico", "cuidado", "acompañamiento", "inclina")


def _norm(text: Column) -> Column:
    return F.trim(F.lower(text))


def _labels(values: Column) -> Column:
    """The texts that say something; null: none."""
    return F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.trim(v) != "")


def _shows(labels: Column, words: tuple[str, ...]) -> Column:
    """Does any of the labels hold one of the words? One pass of one pattern over all of them."""
    return F.rlike(F.array_join(F.transform(labels, _norm), " | "), F.lit("|".join(words)))


def bound_ids(event: Column, labels: Column, catalog: Column, prefix: str) -> Column:
    """Ids of labels: that of the catalog's last entry of the same name, else one made of the event and the label's place; each once.

    catalog: array of struct(id, label).
    """
    none = F.array().cast("array<struct<id: string, label: string>>")

    def one(label: Column, i: Column) -> Column:
        found = F.filter(F.coalesce(catalog, none), lambda c: (_norm(c["label"]) == _norm(label)) & c["id"].isNotNull())
        return F.coalesce(F.try_element_at(found, F.lit(-1))["id"], F.concat(event.cast("string"), F.lit(f":V9_{prefix}_"), F.lpad((i + 1).cast("string"), 2, "0")))

    return F.array_distinct(F.transform(labels, one))


def recover(history: DataFrame, kinds: tuple[str, ...], signals: tuple[str, ...]) -> DataFrame:
    """One observation an event: movie_id, event_id, utility, signal, complete, context, flags, people, conversation, movement, states, reactions, action_ids, object_ids, n_actions.

    history: movie_id, event_id and, each null where there is none, what was said: actions, interactions, objects, emotions, relations (arrays of
    texts), people (number), evidence, intent, reusable, complete; by the calibration of its events: bench_kind, bench_signal; by the older
    observation: old_kind, old_complete, old_context, old_flags (array); action_catalog, object_catalog (arrays of struct(id,
    label)). kinds, signals: the vocabulary. A source counts only where it says something known; then the next one does.
    """
    c = F.col
    x = history.withColumns({n: _labels(c(n)) for n in ("actions", "interactions", "objects", "emotions", "relations")})
    shown = F.concat("actions", "interactions")
    said = F.concat("actions", "interactions", "relations")
    talk = (F.size(said) > 0) & _shows(said, (*DIALOGUE, "cara a cara")) & ~_shows(shown, INDEPENDENT)
    x = x.withColumn("talk", talk)
    known = lambda col, values: F.when(c(col).isin(*values), c(col))
    useful = F.coalesce(c("reusable"), F.lit(False))
    utility = (
        F.when(c("bench_kind").isin(*kinds), c("bench_kind")).when(c("talk"), "generic_dialogue_only").when(_shows(c("actions"), MOVEMENT), "movement").when(_shows(c("actions"), STATE), "useful_state")
        .when(_shows(F.concat("interactions", "actions"), PHYSICAL), "physical_interaction").when(useful & (c("evidence") == "distinct_visible_action_or_reaction"), "concrete_action")
        .when(c("evidence") == "generic_presence_or_movement", "generic_presence_only").otherwise(F.coalesce(known("old_kind", kinds), F.lit("unclear")))
    )
    x = x.withColumn("utility", utility)
    signal = (
        F.when(c("bench_signal").isin(*signals), c("bench_signal")).when(c("talk"), "generic_dialogue_only").when(c("utility") == "physical_interaction", "physical_interaction")
        .when(c("utility").isin("concrete_action", "movement", "object_activity"), "concrete_activity").otherwise("none")
    )
    context = F.when(useful & (c("intent") == "specific_visual_need"), "low").otherwise(F.coalesce(known("old_context", ("low", "medium", "high")), F.lit("unclear")))
    chat = c("talk") | F.exists("interactions", lambda i: _norm(i).contains("convers") | _norm(i).contains("talking"))
    n = F.coalesce("people", F.lit(0))
    x = x.withColumn("action_ids", bound_ids(c("event_id"), shown, c("action_catalog"), "ACTION")).withColumn("object_ids", bound_ids(c("event_id"), c("objects"), c("object_catalog"), "OBJECT"))
    return x.select(
        "movie_id", "event_id", "utility", signal.alias("signal"), F.coalesce(known("complete", ("true", "false", "unclear")), "old_complete", F.lit("unclear")).alias("complete"), context.alias("context"), F.coalesce("old_flags", F.array().cast("array<string>")).alias("flags"),
        F.when(n == 0, "0").when(n == 1, "1").otherwise("2_plus").alias("people"), F.when(chat, "true").otherwise("false").alias("conversation"), F.when(c("utility") == "movement", "present").otherwise("none").alias("movement"), c("emotions").alias("states"),
        F.filter("emotions", lambda e: e != "neutral").alias("reactions"), "action_ids", "object_ids", F.size("action_ids").alias("n_actions"),
    )

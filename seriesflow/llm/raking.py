"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesflow.llm.common import materialize

MARGINS = ("source", "lang", "topic")
#: Target share of a value: its token share to this power, normalised (1: as it is, 0: all alike).
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.7}
#: Raking's bound, far above what targets that can be met need; after STALL sweeps that bring the gap down by less than a
#: hundredth the targets contradict each other, and more sweeps do not help.
SWEEPS, STALL = 400, 25
#: Share of all tokens that sampling keeps.
KEEP = 0.6
#: Words of each topic in English, German, French and Spanish; a word stands under one topic only.
TOPICS = {name: words.split() for name, words in {
    "science": "science sciences scientific scientist scientists research physics chemistry biology theory experiment experiments species"
               " energy planet planets cell cells molecule wissenschaft forschung physik chemie biologie theorie energie"
               " recherche physique chimie théorie expérience espèce ciencia investigación física química biología teoría energía especie",
    "technology": "software computer computers internet program programs code data server network website digital device devices algorithm"
                  " rechner programm programme daten netzwerk gerät ordinateur logiciel réseau données numérique appareil"
                  " ordenador computadora programa datos red dispositivo tecnología technologie technology",
    "business": "business company companies market markets price prices money bank banks trade sales customer customers investment economy"
                " economic unternehmen firma markt preis preise geld handel kunden wirtschaft entreprise entreprises marché prix argent banque"
                " commerce clients économie empresa empresas mercado precio precios dinero banco comercio clientes economía",
    "law": "law laws legal court courts judge license licence copyright rights contract attorney lawyer crime police gesetz gesetze gericht"
           " richter recht rechte vertrag anwalt polizei loi lois tribunal juge droit droits contrat avocat ley leyes"
           " juez derecho derechos contrato abogado policía",
    "politics": "government president minister parliament election elections vote votes party policy political politics state war army regierung"
                " präsident wahl wahlen partei politik krieg gouvernement président ministre élection élections parti politique"
                " guerre gobierno presidente ministro elección elecciones partido política guerra",
    "health": "health medical doctor doctors hospital patient patients disease medicine treatment drug drugs symptoms blood gesundheit arzt"
              " krankenhaus patienten krankheit medizin behandlung blut santé médecin hôpital maladie médecine traitement sang"
              " salud médico enfermedad medicina tratamiento paciente sangre",
    "sport": "sport sports game games team teams player players match league season football soccer goal championship spiel spiele mannschaft"
             " spieler liga saison fußball tor jeu jeux équipe joueur joueurs ligue championnat juego juegos equipo jugador jugadores"
             " partida temporada fútbol campeonato",
    "culture": "music film films movie movies book books art artist artists song songs novel story theatre theater church god history musik"
               " buch bücher kunst künstler lied roman geschichte kirche gott musique livre livres artiste chanson histoire église dieu"
               " música película libro libros arte artista canción novela historia iglesia dios",
}.items()}


def topic_of(text):
    """The topic with the most words of ``TOPICS`` in the whole text, each time a word stands counted; of equal ones
    the first, and ``other`` for a text with none. Words are runs of letters, lower-cased."""
    words = F.split(F.lower(text), "[\\x00-\\x60\\x7B-\\x7F]+")
    told = F.filter(words, lambda w: w.isin(*[x for ws in TOPICS.values() for x in ws]))

    def count(found, k, name):
        return F.struct(F.size(F.filter(found, lambda w: w.isin(*TOPICS[name]))).alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("topic"))

    best = F.transform(F.array(told), lambda found: F.array_max(F.array(*[count(found, k, name) for k, name in enumerate(TOPICS)])))[0]
    return F.when(best["n"] > 0, best["topic"]).otherwise("other")


def rake(cells: DataFrame, targets: DataFrame, margins=MARGINS, sweeps: int = SWEEPS, tolerance: float = 1e-6,
         keep: float | None = None) -> DataFrame:
    """``cells`` (the margins' columns, tokens) plus weight: tokens raked to the ``targets`` (margin, value, share).

    One step scales the weights of all cells that share a margin's value so
    that they sum to the value's target; a sweep takes the margins in turn.
    Sweeps end when no margin is off by more than ``tolerance`` of the total.
    Targets that no weights meet together (their gap stalls, or ``sweeps`` run
    out) end them too, with a warning; column ``gap`` is what the margin
    furthest from its targets was off in the last sweep. Weights sum to 1. Cells with no tokens stay at 0;
    a value of no target keeps its tokens' share.

    With ``keep`` weights sum to ``keep``, as the targets must, and no cell
    weighs more than its tokens' share: a cell that reaches it is whole, and a
    step scales the open cells of a value to what the whole ones leave of its
    target. A whole cell opens again where later steps scale it down.
    """
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] or 1.0
    out = cells.groupBy(*margins).agg(F.sum("tokens").cast("double").alias("tokens")).withColumn("__own", F.col("tokens") / total)
    out = out.withColumn("weight", F.col("__own") * (1.0 if keep is None else keep))
    for m in margins:
        t = targets.where(F.col("margin") == m).select(F.col("value").alias(m), F.col("share").alias(f"__{m}"))
        out = out.join(t, m, "left").withColumn(f"__{m}", F.coalesce(f"__{m}", F.sum("weight").over(Window.partitionBy(m))))
    out = materialize(out, "rake-cells")
    most = F.lit(float("inf")) if keep is None else F.col("__own")
    part = F.least("weight", most)
    gaps = [0.0]
    for sweep in range(sweeps):
        out = out.withColumn("__off", F.lit(0.0))
        for m in margins:
            value, goal = Window.partitionBy(m), F.col(f"__{m}")
            out = out.withColumns({"__now": F.sum(part).over(value),
                                   "__open": F.sum(F.when(F.col("weight") < most, F.col("weight")).otherwise(0.0)).over(value)})
            now, free = F.col("__now"), F.col("__open")
            left = goal - (now - free)  # of the target, for the open cells
            scale = (F.when((free > 0) & (left > 0), left / free).when((now > goal) & (now > 0), goal / now).otherwise(1.0))
            out = out.withColumns({"weight": F.col("weight") * scale, "__off": F.greatest("__off", F.abs(now - goal))})
        out = materialize(out.drop("__now", "__open"), "rake-cells")
        gaps.append(out.agg(F.max("__off")).first()[0] or 0.0)
        if gaps[-1] <= tolerance or sweep >= STALL and min(gaps[-STALL:]) > 0.99 * min(gaps[1:-STALL]):
            break
    if gaps[-1] > tolerance:
        warnings.warn(f"raking ended after {len(gaps) - 1} sweeps with a margin off by {gaps[-1]:.2g} of the total")
    return out.withColumns({"weight": part, "gap": F.lit(gaps[-1])}).drop("__own", "__off", *[f"__{m}" for m in margins])


def attainable(cells: DataFrame, targets: DataFrame, keep: float, margins=MARGINS) -> DataFrame:
    """Targets (margin, value, share) in shares of all tokens that sum to ``keep`` and that no value's tokens fall short of.

    A value with fewer tokens than its target asks for is taken whole, and what
    it lacks goes to the margin's other values, in proportion to their targets.
    """
    from functools import reduce
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] or 1.0
    parts = [cells.groupBy(F.col(m).alias("value")).agg((F.sum("tokens") / total).alias("own")).select(F.lit(m).alias("margin"), "value", "own")
             for m in margins]
    have = reduce(DataFrame.unionByName, parts).join(targets, ["margin", "value"], "left")
    have = materialize(have.select("margin", "value", "own", F.coalesce("share", "own").alias("share")), "rake-targets")
    level = dict.fromkeys(margins, 0.0)
    while True:
        asked = F.col("share") * reduce(lambda c, m: F.when(F.col("margin") == m, level[m]).otherwise(c), margins, F.lit(0.0))
        whole = F.col("own") <= asked
        sums = have.groupBy("margin").agg(F.sum(F.when(whole, F.col("own")).otherwise(0.0)).alias("held"),
                                          F.sum(F.when(whole, 0.0).otherwise(F.col("share"))).alias("open")).collect()  # one row a margin
        rise = {r.margin: (keep - r.held) / r.open for r in sums if r.open > 0}
        rise = {m: x for m, x in rise.items() if x > level[m] * (1 + 1e-12)}
        if not rise:  # each round takes more values whole, or is the last
            return have.select("margin", "value", F.least("own", asked).alias("share"))
        level |= rise


def tempered_targets(cells: DataFrame, temper: dict[str, float] = TEMPER) -> DataFrame:
    """Targets (margin, value, share) from the tokens of each value to a power, normalised over the margin."""
    from functools import reduce
    parts = [cells.groupBy(F.col(m).alias("value")).agg(F.sum("tokens").cast("double").alias("t")).where("t > 0")
             .select(F.lit(m).alias("margin"), "value", F.pow("t", F.lit(p)).alias("w")) for m, p in temper.items()]
    w = Window.partitionBy("margin")
    return reduce(DataFrame.unionByName, parts).select("margin", "value", (F.col("w") / F.sum("w").over(w)).alias("share"))


def mix(docs: DataFrame, temper: dict[str, float] = TEMPER, targets: DataFrame | None = None, salt: str = "mix",
        keep: float = KEEP) -> DataFrame:
    """``docs`` plus topic, n_tokens, probability, sampled.

    Tokens are words. Cells of (source, lang, topic) hold their token sums; raking
    gives each cell a factor (raked share / own share). A document is sampled
    with probability min(1, c * factor), where c is such that ``keep`` of all
    tokens are expected to stay: cells at 1 are kept whole and the open ones
    are raked again, so a rare cell scales no other. Expected token shares meet
    the targets (``tempered_targets`` unless given) but for values with fewer
    tokens than their target asks for (``attainable``). No document repeats. The
    draw is the md5 of doc_id and ``salt`` against the probability: the same
    in every run. Null source or lang is a value of its own (``-``); null or
    empty texts have no tokens and probability 1; rows with a null doc_id or
    the same doc_id draw alike. Existing columns of these names are replaced.
    An empty table stays empty; a very long text is counted whole, within its task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({
        "topic": topic_of(text), "n_tokens": F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")).cast("long"),
        "__source": F.coalesce(F.col("source"), F.lit("-")), "__lang": F.coalesce(F.col("lang"), F.lit("-"))})
    cells = materialize(keyed.groupBy(F.col("__source").alias("source"), F.col("__lang").alias("lang"), "topic")
                        .agg(F.sum("n_tokens").alias("tokens")), "rake-tokens")
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] or 1.0
    goals = attainable(cells, targets if targets is not None else tempered_targets(cells, temper), keep)
    share = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") * total / F.col("tokens")))
    raked = materialize(rake(cells, goals, keep=keep).select(F.col("source").alias("__source"), F.col("lang").alias("__lang"), "topic",
                                                             share.alias("__p")), "rake-factors")
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(salt)).cast("binary")), 1, 12),
                  16, 10).cast("double") / float(16 ** 12)
    joined = keyed.join(raked, ["__source", "__lang", "topic"], "left")
    joined = joined.withColumn("probability", F.when(F.col("n_tokens") > 0, F.col("__p")).otherwise(1.0))
    return joined.withColumn("sampled", draw < F.col("probability")).drop("__source", "__lang", "__p")


def sampled(docs: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``docs``, all columns as they are."""
    names = ("topic", "n_tokens", "probability", "sampled")
    kept = {c: f"__own_{c}" for c in docs.columns if c in names}
    out = mix(docs.withColumnsRenamed(kept), **options).where("sampled").drop(*names)
    return out.withColumnsRenamed({v: k for k, v in kept.items()}).select(*[F.col(f"`{c}`") for c in docs.columns])

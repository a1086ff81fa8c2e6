"""Record linkage: mentions of persons against a registry of employment, by gates and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.lists import agencies_to_check
from ..functions.similarity import component_similarity, string_features, weighted_similarity
from ..functions.text import _text, guard_blocks

AUTO, REVIEW = "auto_matched", "review"


def _upper(c) -> Column:
    return F.upper(F.trim(_text(c)))


#: Rows of one name that meet as a block: a pair of blocks is the most that a key of the join has.
NAME_BLOCK = 2048


def name_net(mentions: DataFrame, registry: DataFrame, n: int = 2) -> DataFrame:
    """Pairs with the same last name and beginning of the first, or the same first name and beginning of the last.

    Names meet before rows do: each side of the OR is an equi-join of distinct names, and each pair of names comes once.
    Rows of a pair of names are dealt to blocks, and every two blocks are a key of their own, so no task gets all
    rows of a frequent name. Mentions have ``mention_uid``, ``mention_first_name`` and ``mention_last_name``; an empty
    first name begins like none in the registry.
    """
    m = mentions.withColumns({"__mf": F.when(_upper("mention_first_name") == "", "Z").otherwise(_upper("mention_first_name")), "__ml": _upper("mention_last_name")})
    r = registry.withColumns({"__rf": _upper("post_first_name"), "__rl": _upper("post_last_name")})
    ms, rs = in_blocks(m, ["__mf", "__ml"], "__mb"), in_blocks(r, ["__rf", "__rl"], "__rb")
    a = ms.join(rs, (F.substring("__mf", 1, n) == F.substring("__rf", 1, n)) & (F.col("__ml") == F.col("__rl")))
    b = ms.join(rs, (F.col("__mf") == F.col("__rf")) & (F.substring("__ml", 1, n) == F.substring("__rl", 1, n)))
    return block_join(m, r, a.unionByName(b).distinct(), ["__mf", "__ml"], ["__rf", "__rl"]).select(*mentions.columns, *registry.columns)


def in_blocks(rows: DataFrame, names: list[str], count: str) -> DataFrame:
    """The distinct names with the number of blocks that their rows take."""
    return rows.groupBy(*names).agg(F.ceil(F.count("*") / NAME_BLOCK).cast("int").alias(count))


def block_join(m: DataFrame, r: DataFrame, nets: DataFrame, one: list[str], two: list[str]) -> DataFrame:
    """Rows of ``m`` and ``r`` whose names (columns ``one`` and ``two``) are a row of ``nets``, with its other columns.

    ``nets`` has each pair of names once, with the numbers of blocks ``__mb`` and ``__rb`` of both (:func:`in_blocks`).
    Names are not null.
    """
    key = [*one, *two, "__p", "__q"]

    def dealt(rows: DataFrame, names: list[str], some: DataFrame, own: str, n_own: str, other: str, n_other: str) -> DataFrame:
        out = rows.withColumn("__h", F.xxhash64(*[c for c in rows.columns if c not in names])).join(some, names)
        out = out.withColumns({own: F.pmod("__h", n_own).cast("int"), other: F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))})
        return out.drop("__h", "__mb", "__rb").withColumn("__k", F.xxhash64(*key)).repartition(_tasks(rows), "__k", *key)

    left = dealt(m, one, nets, "__p", "__mb", "__q", "__rb")
    right = dealt(r, two, nets.select(*one, *two, "__mb", "__rb"), "__q", "__rb", "__p", "__mb")
    # A block of the second side is one row with an array, so the join has few rows and the pairs come from the array.
    packed = right.groupBy("__k", *key).agg(F.collect_list(F.struct(*[c for c in r.columns if c not in two])).alias("__rows"))
    rest = [c for c in left.columns if c not in ("__k", *key)]
    return left.join(packed, ["__k", *key]).select(*rest, F.inline("__rows"))


#: Rows that a task of a large join is to get.
ROWS_PER_TASK = 500_000


def _tasks(df: DataFrame, rows: int = 0) -> int:
    """Tasks of a join that makes far more than it reads: by number, as their input would be put together to a few; more
    of them if each would get too many of so many rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def in_years(start, end, year, as_of, buffer: int = 1) -> Column:
    """Whether a stint meets the years around ``year``; it is open where its end is missing or before 1950."""
    last = F.coalesce(F.when(F.year(end) >= 1950, F.year(end)), F.year(as_of))
    return F.coalesce((F.year(start) <= F.col(year) + buffer) & (last >= F.col(year) - buffer), F.lit(False))


def overlaps_day(day, start, end) -> Column:
    """Whether a stint holds a day; a missing end is open, a missing start is not known to."""
    return F.coalesce((F.col(start) <= F.col(day)) & (F.col(end).isNull() | (F.col(end) >= F.col(day))), F.lit(False))


def county_kept(candidates: DataFrame, county: str = "mention_county") -> DataFrame:
    """All rows of persons with a row in the mention's county; mentions without one, and of corrections, keep all."""
    w = W.partitionBy("mention_uid", "post_person_nbr")
    inside = F.max(F.coalesce(F.lower("county") == F.lower(county), F.lit(False)).cast("int")).over(w)
    free = F.col(county).isNull() | (_upper("mention_agency_type") == "CORRECTIONS")
    return candidates.withColumn("__in", inside).where(free | (F.col("__in") == 1)).drop("__in")


def type_kept(candidates: DataFrame) -> DataFrame:
    """Rows of the mention's agency type, if any candidate of the mention is of another type than police."""
    varied = F.max((_upper("post_agency_type") != "POLICE").cast("int")).over(W.partitionBy("mention_uid"))
    return candidates.withColumn("__v", varied).where((F.col("__v") == 0) | (_upper("post_agency_type") == _upper("mention_agency_type"))).drop("__v")


def candidates(mentions: DataFrame, registry: DataFrame, as_of, buffer: int = 1) -> DataFrame:
    """Registry rows that may be a mention: names first (the equi-joins), then years, county and agency type."""
    near = name_net(mentions, registry).where(in_years("post_start_date", "post_end_date", "incident_year", as_of, buffer))
    return type_kept(county_kept(near)) if "mention_county" in mentions.columns else type_kept(near)


def blocking_keys(df: DataFrame, prefix: int = 1, suffix: int = 2) -> Column:
    """Annotations of an incident and registry pair: beginnings and ends of names, first letters, and valid dates."""
    keys = [F.when(overlaps_day("incident_date", "post_start_date", "post_end_date"), F.lit("date_valid"))]
    for side, tag in (("incident", "i"), ("post", "p")):
        for part in ("first", "last"):
            v = F.lower(_text(f"{side}_{part}_name"))
            keys += [F.when(F.length(v) >= prefix, F.concat(F.lit(f"{tag}_{part}_pre_"), F.substring(v, 1, prefix))), F.when(F.length(v) >= suffix, F.concat(F.lit(f"{tag}_{part}_suf_"), F.right(v, F.lit(suffix))))]
    for part, a, b in (("middle", "incident_middle_name", "post_middle_name"), ("suffix", "incident_suffix", "post_suffix")):
        x, y = F.lower(_text(a)), F.lower(_text(b))
        keys.append(F.when((x != "") & (y != ""), F.concat_ws("_", F.lit(part), F.substring(x, 1, 1), F.substring(y, 1, 1))))
    for side, tag in (("incident", "i"), ("post", "p")):
        v = F.lower(_text(f"{side}_name"))
        keys += [F.when((v != "") & (F.length(v) >= prefix), F.concat(F.lit(f"{tag}_name_pre_"), F.substring(v, 1, prefix))), F.when(F.length(v) >= suffix, F.concat(F.lit(f"{tag}_name_suf_"), F.right(v, F.lit(suffix))))]
    named = (_text("incident_first_name") != "") & (_text("incident_last_name") != "") & (_text("post_first_name") != "") & (_text("post_last_name") != "")
    return F.when(named, F.array_join(F.array_compact(F.array(*keys)), "|")).otherwise("missing_required_names")


def name_features(df: DataFrame) -> DataFrame:
    """Similarities of each part of the names and of the whole; a missing middle name counts half."""
    out = df
    for part, a, b in (("first", "mention_first_name", "post_first_name"), ("middle", "mention_middle_name", "post_middle_name"), ("last", "mention_last_name", "post_last_name"), ("suffix", "mention_suffix", "post_suffix")):
        f = string_features(a, b)
        missing = (F.col(a).isNull() | F.col(b).isNull()) & F.lit(part == "middle")
        out = out.withColumn("__f", f)
        out = out.withColumns({f"{part}_name_{k}": F.when(missing, 0.5).otherwise(F.col("__f")[k]) for k in ("jaro", "levenshtein", "length_ratio")}).drop("__f")
    whole = lambda side: F.concat_ws(" ", *[F.col(f"{side}_{p}") for p in ("first_name", "middle_name", "last_name", "suffix")])
    out = out.withColumns({"mention_full_name": whole("mention"), "post_full_name": whole("post")}).withColumn("__f", string_features("mention_full_name", "post_full_name"))
    return out.withColumns({f"full_name_{k}": F.col("__f")[k] for k in ("jaro", "levenshtein", "length_ratio")}).drop("__f")


def name_score(df: DataFrame) -> DataFrame:
    """``match_probability`` by weighted similarity of the names' parts: the scorer that needs no model."""
    parts = {"first": component_similarity("mention_first_name", "post_first_name"), "last": component_similarity("mention_last_name", "post_last_name"), "middle": component_similarity("mention_middle_name", "post_middle_name", initials=True), "suffix": component_similarity("mention_suffix", "post_suffix")}
    named = df.withColumns({f"__{k}": c for k, c in parts.items()})
    return named.withColumn("match_probability", weighted_similarity({k: F.col(f"__{k}") for k in parts})).drop(*[f"__{k}" for k in parts])


def exact_name() -> Column:
    """First and last names alike without case; a missing name is like none."""
    same = lambda a, b: F.coalesce(_col_upper(a) == _col_upper(b), F.lit(False))
    return same("mention_first_name", "post_first_name") & same("mention_last_name", "post_last_name")


def _col_upper(c) -> Column:
    return F.upper(F.trim(F.col(c)))


def above(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.where(F.col("match_probability") > threshold)


def ambiguous_mentions(df: DataFrame) -> DataFrame:
    return df.groupBy("mention_uid").agg(F.count_distinct("post_person_nbr").alias("persons")).where("persons >= 2")


def best_rows(df: DataFrame) -> DataFrame:
    """The likeliest row of each mention (ties: person, then start)."""
    w = W.partitionBy("mention_uid").orderBy(F.desc("match_probability"), "post_person_nbr", "post_start_date")
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def top_candidates(df: DataFrame, key: str, score: str, tie: str, n: int = 3) -> DataFrame:
    """The ``n`` best rows of each key, with empty rows up to that many."""
    w = W.partitionBy(key).orderBy(F.desc(score), tie)
    best = df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    places = df.select(key).distinct().withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(n))))
    return places.join(best, [key, "rank"], "left")


def same_name_persons(mentions: DataFrame, registry: DataFrame) -> DataFrame:
    """How many persons of the mention's state share its first and last name.

    Persons are counted by name and state before mentions meet the counts. Only a mention that comes under several
    names or states meets the persons themselves, as one of them may be counted under each.
    """
    key = ["f", "l", "s"]
    m = mentions.select("mention_uid", _upper("mention_first_name").alias("f"), _upper("mention_last_name").alias("l"), _upper("state").alias("s")).distinct()
    r = registry.select(_upper("post_first_name").alias("f"), _upper("post_last_name").alias("l"), _upper("state").alias("s"), "post_person_nbr").where(F.col("post_person_nbr").isNotNull()).distinct()
    per = m.join(r.groupBy(key).agg(F.count("*").alias("n")), key, "left").groupBy("mention_uid").agg(F.count("*").alias("names"), F.coalesce(F.max("n"), F.lit(0)).alias("n"))
    several = m.join(per.where("names > 1").select("mention_uid"), "mention_uid", "left_semi")
    again = several.join(r, key, "left").groupBy("mention_uid").agg(F.count_distinct("post_person_nbr").alias("same_name"))
    return per.where("names = 1").select("mention_uid", F.col("n").alias("same_name")).unionByName(again)


def gate(name: str, status: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), status.alias("status"), detail.alias("detail"))


def _stand_ins(mentions: DataFrame) -> DataFrame:
    """``mentions`` with ``__of``: the least id of those that are alike but for it; one with several rows is its own."""
    rows = mentions.groupBy("mention_uid").agg(F.count("*").alias("__n"))
    key = F.struct(F.when(F.col("__n") > 1, F.col("mention_uid")).alias("own"), *[c for c in mentions.columns if c != "mention_uid"])
    keyed = mentions.join(rows, "mention_uid").withColumn("__key", key).drop("__n")
    return keyed.join(keyed.groupBy("__key").agg(F.min("mention_uid").alias("__of")), "__key").drop("__key")


def _kind(kinds: DataFrame) -> Column:
    return F.struct(*[c for c in kinds.columns if c not in ("post_person_nbr", "__count", "__single")])


def _kinds(registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are alike but for the person, as one with the least person, ``__count`` of rows and ``__single`` of
    persons that come under no other kind; and ``__kind, __person`` of the persons that do."""
    rows = registry.withColumn("__nobody", F.col("post_person_nbr").isNull())
    own = [c for c in rows.columns if c != "post_person_nbr"]
    each = rows.where("NOT __nobody").select(F.struct(*own).alias("__kind"), F.col("post_person_nbr").alias("__person")).distinct()
    many = each.groupBy("__person").agg(F.count("*").alias("__n")).where("__n > 1").select("__person")
    single = each.join(many, "__person", "left_anti").groupBy("__kind").agg(F.count("*").alias("__single"))
    kinds = rows.groupBy(own).agg(F.min("post_person_nbr").alias("post_person_nbr"), F.count("*").alias("__count")).withColumn("__kind", F.struct(*own))
    return kinds.join(single, "__kind", "left").drop("__kind").fillna(0, ["__single"]), each.join(many, "__person", "left_semi")


def _candidate_kinds(mentions: DataFrame, kinds: DataFrame, registry: DataFrame, as_of) -> DataFrame:
    """Candidates of the mentions that stand for others, by kinds of registry rows.

    A county keeps rows by their persons, so there the rows themselves are made, each as a kind of one.
    """
    first = mentions.where("mention_uid = __of").drop("__of")
    if "mention_county" not in mentions.columns:
        return candidates(first, kinds, as_of)
    return candidates(first, registry.withColumnRenamed("state", "post_state"), as_of).withColumn("__count", F.lit(1))


def resolve(mentions: DataFrame, registry: DataFrame, common_names: DataFrame, as_of, threshold: float = 0.5, require_state: bool = True, scorer=name_score, valid_agency: Column | None = None) -> DataFrame:
    """One row for each mention: ``status, reason, gates, ambiguous, post_person_nbr, match_probability``.

    The first gate that fails decides: state, common last name, persons of the same name, candidates, exact name above
    the threshold, several such persons, agency. ``common_names`` has ``last_name`` in upper case; ``valid_agency`` is
    over the best row (by default the agencies are named alike). All mentions are resolved in one plan: mentions that
    differ in their id alone are compared once, with registry rows that differ in the person alone, which are counted.
    ``scorer`` sees of such mentions and rows the one with the least id.
    """
    common = common_names.select(F.upper(F.trim("last_name")).alias("__last")).distinct().withColumn("__common", F.lit(True))
    # The list of common names is small by nature; Spark broadcasts it if it is.
    base = mentions.join(common, _upper("mention_last_name") == F.col("__last"), "left").drop("__last").join(same_name_persons(mentions, registry), "mention_uid", "left")
    alike_mentions, kinds, shared = _stand_ins(mentions), *_kinds(registry.withColumnRenamed("state", "post_state"))
    met = _candidate_kinds(alike_mentions, kinds, registry, as_of)
    per = met.groupBy("mention_uid").agg(F.sum("__count").alias("n_candidates"))
    # A scorer looks at one row at a time, so rows that cannot be eligible need not be scored.
    good = scorer(met.where(exact_name())).where(F.col("match_probability") > threshold)
    if "mention_county" in mentions.columns:
        persons = good.groupBy("mention_uid").agg(F.count("*").alias("n_eligible"), F.count_distinct("post_person_nbr").alias("n_persons"))
    else:
        several = good.select("mention_uid", _kind(kinds).alias("__kind")).join(shared, "__kind").groupBy("mention_uid").agg(F.count_distinct("__person").alias("__several"))
        persons = good.groupBy("mention_uid").agg(F.sum("__count").alias("n_eligible"), F.sum("__single").alias("__single")).join(several, "mention_uid", "left")
        persons = persons.select("mention_uid", "n_eligible", (F.col("__single") + F.coalesce("__several", F.lit(0))).alias("n_persons"))
    agencies = agencies_to_check("mention_agency", "mentioned_agencies")
    alike = F.exists(agencies, lambda a: F.lower(F.trim(a)) == F.lower(F.trim(F.col("post_agency_name")))) if valid_agency is None else valid_agency
    best = best_rows(good).withColumn("guard", guard_blocks(agencies, "post_agency_name")).withColumn("valid", F.coalesce(alike & ~F.col("guard"), F.lit(False)))
    found = per.join(persons, "mention_uid", "left").join(best.select("mention_uid", "post_person_nbr", "match_probability", "guard", "valid"), "mention_uid", "left")
    rows = base.join(alike_mentions.select("mention_uid", "__of").distinct(), "mention_uid").join(found.withColumnRenamed("mention_uid", "__of"), "__of", "left")
    no_state = F.lit(require_state) & (_text("state") == "")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    reason = (
        F.when(no_state, "No state provided").when(F.col("__common"), F.concat(F.lit("Common last name "), _upper("mention_last_name"))).when(n("same_name") >= 2, "Several persons of the same name")
        .when(n("n_candidates") == 0, "No candidates found").when(n("n_eligible") == 0, "No exact name above the threshold").when(n("n_persons") >= 2, "Several persons with the exact name")
        .when(F.col("guard"), "Source agency is not law enforcement").when(~F.col("valid"), "Agency cannot be validated").otherwise("")
    )
    gates = F.array(
        gate("State present", F.when(no_state, "fail").otherwise("pass"), _text("state")),
        gate("Common last name", F.when(F.col("__common"), "flag").otherwise("pass"), F.when(F.col("__common"), _upper("mention_last_name")).otherwise("")),
        gate("Unique name in state", F.when(n("same_name") >= 2, "flag").otherwise("pass"), n("same_name").cast("string")),
        gate("Candidates found", F.when(n("n_candidates") == 0, "fail").otherwise("pass"), n("n_candidates").cast("string")),
        gate("Exact-name match", F.when(n("n_eligible") == 0, "fail").otherwise("pass"), n("n_eligible").cast("string")),
        gate("Not ambiguous", F.when(n("n_persons") >= 2, "flag").when(n("n_eligible") == 0, "skip").otherwise("pass"), n("n_persons").cast("string")),
        gate("Agency validation", F.when(F.col("valid") & (n("n_persons") == 1), "pass").when(n("n_persons") == 1, "fail").otherwise("skip"), F.lit("")),
    )
    # Gates are listed up to the one that sends a mention to review; the last three are always listed once there are candidates.
    upto = F.when(no_state, 1).when(F.col("__common"), 2).when(n("same_name") >= 2, 3).when(n("n_candidates") == 0, 4).otherwise(7)
    out = rows.withColumn("reason", reason).withColumn("gates", F.slice(gates, F.lit(1), upto))
    auto = F.col("reason") == ""
    return out.select("mention_uid", F.when(auto, AUTO).otherwise(REVIEW).alias("status"), "reason", "gates", (n("n_persons") >= 2).alias("ambiguous"), F.when(auto, F.col("post_person_nbr")).alias("post_person_nbr"), F.when(auto, F.col("match_probability")).alias("match_probability"))


#: Outputs by what became of a mention.
def output_bucket() -> Column:
    early = F.size("gates") < 5
    return F.when(F.col("status") == AUTO, "auto").when(early, "early_filtered").otherwise("failed")


def link_prf(results: DataFrame, gold: DataFrame) -> DataFrame:
    """Precision and recall of automatic links against ``mention_uid, post_person_nbr``; blank persons are no links."""
    from .metrics import set_prf

    key = F.concat_ws("|", "mention_uid", F.col("post_person_nbr").cast("string")).alias("link")
    return set_prf(results.where(F.col("status") == AUTO).select(key), gold.where(_text("post_person_nbr") != "").select(key), "link")

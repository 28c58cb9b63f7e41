"""Profile prompts and rule-based step plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.functions.text import fill_slots, first_present, strip_suffix

Step = tuple[str, Sequence[str]]


def profile_prompt(template: str, fields: Mapping[str, tuple[str, str]], stack: Column, none_text: str) -> Column:
    """Fill a prompt template from profile columns, each with its default, and a joined list of skills."""
    slots = {name: first_present(column, default=default) for name, (column, default) in fields.items()}
    listed = F.when(F.size(F.coalesce(stack, F.array().cast("array<string>"))) > 0, F.array_join(stack, ", "))
    return fill_slots(F.lit(template), stack=F.coalesce(listed, F.lit(none_text)), **slots)


def _case_map(key: Column, values: Mapping[str, Column], default: Column) -> Column:
    """Lookup in a small fixed table as one `case` expression: templates are constants of the plan, so
    looking them up needs no join."""
    chain = None
    for name, value in values.items():
        chain = F.when(key == name, value) if chain is None else chain.when(key == name, value)
    return default if chain is None else chain.otherwise(default)


def _strings(items: Sequence[str]) -> Column:
    return F.array(*[F.lit(x) for x in items])


def rule_plan(
    profiles: DataFrame,
    *,
    job: str,
    company: str,
    period: str,
    plans: Mapping[str, Sequence[Step]],
    default_plan: str,
    weeks: Mapping[str, int],
    default_weeks: int,
    resources: Mapping[str, Sequence[str]],
    default_resource: str,
    texts: Mapping[str, str],
    insights: Mapping[str, str],
    default_insight: str,
) -> DataFrame:
    """Add a plan to each profile: `title, summary, total_weeks, steps, portfolio_tip, market_insight`.

    Steps come from the job's template (or the default one); their length is the period's weeks divided by
    the number of steps, at least one. Each step lists its skills without parenthesised suffixes, up to
    three distinct resources of the first two skills, and a milestone. `texts` holds the patterns of the
    generated sentences, `insights` maps a word inside the company text to its insight.
    """
    def template(steps: Sequence[Step]) -> Column:
        return F.array(*[
            F.struct(F.lit(title).alias("title"), _strings(skills).alias("skills")) for title, skills in steps
        ])

    def skill_resources(skill: Column) -> Column:
        return _case_map(skill, {k: _strings(v) for k, v in resources.items()}, _strings([default_resource]))

    def step(entry: Column, i: Column) -> Column:
        names = F.transform(entry["skills"], lambda s: strip_suffix(s))
        found = F.flatten(F.transform(F.slice(names, 1, 2), skill_resources))
        return F.struct(
            (i + 1).cast("int").alias("step"),
            entry["title"].alias("title"),
            F.replace(F.lit(texts["duration"]), F.lit("{weeks}"), F.col("_step_weeks").cast("string")).alias("duration"),
            names.alias("techs"),
            fill_slots(
                F.lit(texts["description"]), title=entry["title"], techs=F.array_join(F.slice(names, 1, 3), ", ")
            ).alias("description"),
            F.slice(F.array_distinct(found), 1, 3).alias("resources"),
            F.replace(F.lit(texts["milestone"]), F.lit("{tech}"), F.get(names, F.lit(0))).alias("milestone"),
        )

    def sentence(name: str) -> Column:
        return fill_slots(F.lit(texts[name]), job=F.col(job), company=F.col(company), period=F.col(period))

    chosen = _case_map(F.col(job), {k: template(v) for k, v in plans.items()}, template(plans[default_plan]))
    total = _case_map(F.col(period), {k: F.lit(v) for k, v in weeks.items()}, F.lit(default_weeks))
    insight = F.lit(default_insight)
    for word, text in reversed(list(insights.items())):
        insight = F.when(F.contains(F.col(company), F.lit(word)), F.lit(text)).otherwise(insight)
    work = profiles.withColumn("_plan", chosen).withColumn("total_weeks", total)
    work = work.withColumn(
        "_step_weeks", F.greatest(F.lit(1), F.floor(F.col("total_weeks") / F.size("_plan")).cast("int"))
    )
    return work.select(
        *profiles.columns,
        sentence("title").alias("title"),
        sentence("summary").alias("summary"),
        "total_weeks",
        F.transform("_plan", step).alias("steps"),
        F.lit(texts["portfolio_tip"]).alias("portfolio_tip"),
        insight.alias("market_insight"),
    )


def step_summaries(steps: str, pattern: str) -> Column:
    """One line per step from a pattern with `{step}`, `{title}`, `{techs}` (first three) and `{duration}`."""
    return F.transform(steps, lambda s: fill_slots(
        F.lit(pattern), step=s["step"].cast("string"), title=s["title"],
        techs=F.array_join(F.slice(s["techs"], 1, 3), ", "), duration=s["duration"],
    ))

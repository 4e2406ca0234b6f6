"""Parameters of a run, one plain object."""

from __future__ import annotations

from dataclasses import dataclass, field

from offerscope.vocab.skills import DEFAULT_SKILLS, Skill


@dataclass(frozen=True)
class Settings:
    # Plausible yearly salaries, legal hours per year, age limit, terms kept per role.
    data_mode: str = "auto"  # auto | real | all
    salary_bounds: tuple[float, float] = (18000.0, 200000.0)
    hours_per_year: int = 1607
    max_age_days: int | None = 365
    top_terms: int = 25
    term_min_df: int = 3
    term_max_df: float = 0.6
    skills: tuple[Skill, ...] = field(default=DEFAULT_SKILLS)

"""Study configuration: groups, years, periods and topics as plain frozen values."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Topic:
    name: str
    description: str
    keywords: tuple[str, ...]


@dataclass(frozen=True)
class Period:
    """Inclusive range of calendar years; ``None`` leaves an end open."""

    name: str
    first_year: int | None
    last_year: int | None


# The default groups, years, periods and topic keywords.
DEFAULT_GROUPS = ("cscareerquestions", "csmajors", "recruitinghell", "jobs")
DEFAULT_YEAR_MIN = 2017
DEFAULT_YEAR_MAX = 2025
DEFAULT_PERIODS = (
    Period("pre-COVID", 2017, 2019),
    Period("COVID", 2020, 2021),
    Period("post-COVID", 2022, None),
)
OUTSIDE_PERIOD = "outside-study-range"
UNKNOWN_PERIOD = "unknown"
DEFAULT_TOPICS = (
    Topic(
        "layoffs_market",
        "Layoffs, market contraction, hiring freezes, severance, and related market stress.",
        (
            "layoff", "layoffs", "laid off", "laid-off", "rif", "reduction in force", "severance",
            "hiring freeze", "hiring freezes", "freeze hiring", "job market", "market contraction",
            "headcount reduction", "downsizing", "recession",
        ),
    ),
    Topic(
        "recruiting_pipeline",
        "Recruiting process, interviews, offers, rejections, applications, and internship/new-grad pipeline.",
        (
            "recruiter", "recruiters", "ghosted", "ghosting", "rejection", "rejections", "reject",
            "interview", "interviews", "phone screen", "onsite", "on-site", "offer", "offers", "oa",
            "online assessment", "leetcode", "new grad", "newgrad", "internship", "internships",
            "intern", "application", "applications", "resume", "referral", "referrals",
        ),
    ),
    Topic(
        "compensation",
        "Salary, total compensation, equity, RSUs, negotiation, and pay discussions.",
        (
            "tc", "salary", "salaries", "compensation", "comp", "negotiate", "negotiation", "equity",
            "rsu", "rsus", "stock grant", "base pay", "base salary", "pay", "hourly", "bonus", "bonuses",
        ),
    ),
    Topic(
        "work_mode",
        "Remote work, hybrid work, return-to-office, and work-location mode.",
        (
            "remote", "wfh", "work from home", "hybrid", "rto", "return to office", "return-to-office",
            "on site", "onsite", "on-site", "in office", "in-office",
        ),
    ),
    Topic(
        "companies",
        "Specific companies frequently discussed in CS job-market conversations.",
        (
            "amazon", "google", "meta", "microsoft", "apple", "qualcomm", "netflix", "tesla", "nvidia",
            "openai",
        ),
    ),
    Topic(
        "ai_llm",
        "AI, LLMs, ChatGPT, Copilot, and generative AI topics.",
        (
            "chatgpt", "gpt", "llm", "llms", "ai", "artificial intelligence", "copilot", "generative ai",
            "gen ai", "machine learning", "ml", "prompt engineering", "automation",
        ),
    ),
)
SENTIMENTS = ("negative", "positive")


@dataclass(frozen=True)
class Study:
    """Everything a run is parameterised by; the defaults are the fixed values above."""

    groups: tuple[str, ...] = DEFAULT_GROUPS
    year_min: int = DEFAULT_YEAR_MIN
    year_max: int = DEFAULT_YEAR_MAX
    periods: tuple[Period, ...] = DEFAULT_PERIODS
    topics: tuple[Topic, ...] = field(default=DEFAULT_TOPICS)
    # Which period / topic plays which part in the four hypotheses.
    before_period: str = "pre-COVID"
    after_period: str = "post-COVID"
    recruiting_topic: str = "recruiting_pipeline"
    layoffs_topic: str = "layoffs_market"
    ai_topic: str = "ai_llm"
    min_user_posts: int = 3

    @property
    def period_names(self) -> tuple[str, ...]:
        return tuple(p.name for p in self.periods)

    @property
    def topic_names(self) -> tuple[str, ...]:
        return tuple(t.name for t in self.topics)

    @property
    def topic_columns(self) -> tuple[str, ...]:
        return tuple(topic_column(t.name) for t in self.topics)

    @property
    def earlier_periods(self) -> tuple[str, ...]:
        """The configured periods that come before ``after_period``."""
        names = self.period_names
        return names[: names.index(self.after_period)]


def topic_column(name: str) -> str:
    return f"topic_{name}"


def matched_column(name: str) -> str:
    return f"matched_keywords_{name}"

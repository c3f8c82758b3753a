"""Quality rules as data: the rule kinds, the three suites and the checkpoint."""

from __future__ import annotations

from dataclasses import dataclass

# Rule names.
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
OF_TYPE = "expect_column_values_to_be_of_type"

KINDS = (EXISTS, NOT_NULL, UNIQUE, BETWEEN, IN_SET, OF_TYPE)


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    low: int | float | str | None = None
    high: int | float | str | None = None
    allowed: tuple[str, ...] | None = None
    family: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown rule {self.kind!r}")
        if self.kind == BETWEEN and self.low is None and self.high is None:
            raise ValueError(f"range rule on {self.column!r} has no bound")
        if self.kind == IN_SET and self.allowed is None:
            raise ValueError(f"set rule on {self.column!r} has no set")
        if self.kind == OF_TYPE and self.family is None:
            raise ValueError(f"type rule on {self.column!r} has no type")


@dataclass(frozen=True)
class Suite:
    name: str
    rules: tuple[Rule, ...]


# The 27 rules of the silver tables and what they are paired with.
STORY_SUITE = Suite(
    "hackernews_expectations",
    (
        Rule(NOT_NULL, "id"),
        Rule(UNIQUE, "id"),
        Rule(NOT_NULL, "title"),
        Rule(BETWEEN, "score", low=0),
        Rule(OF_TYPE, "time", family="INTEGER"),
        Rule(IN_SET, "type", allowed=("story", "comment", "job", "poll", "pollopt")),
    ),
)
EVENT_SUITE = Suite(
    "github_expectations",
    (
        Rule(EXISTS, "id"),
        Rule(EXISTS, "type"),
        Rule(EXISTS, "created_at"),
        Rule(EXISTS, "actor_login"),
        Rule(EXISTS, "repo_name"),
        Rule(NOT_NULL, "id"),
        Rule(UNIQUE, "id"),
        Rule(
            IN_SET,
            "type",
            allowed=(
                "PushEvent",
                "WatchEvent",
                "ForkEvent",
                "PullRequestEvent",
                "IssuesEvent",
                "CreateEvent",
                "DeleteEvent",
            ),
        ),
        Rule(OF_TYPE, "created_at", family="TIMESTAMP"),
    ),
)
VIDEO_SUITE = Suite(
    "youtube_expectations",
    (
        Rule(EXISTS, "video_id"),
        Rule(EXISTS, "title"),
        Rule(EXISTS, "view_count"),
        Rule(EXISTS, "like_count"),
        Rule(EXISTS, "published_at"),
        Rule(EXISTS, "channel_title"),
        Rule(NOT_NULL, "video_id"),
        Rule(NOT_NULL, "title"),
        Rule(UNIQUE, "video_id"),
        Rule(BETWEEN, "view_count", low=0, high=10000000000),
        Rule(BETWEEN, "like_count", low=0, high=500000000),
        Rule(OF_TYPE, "published_at", family="TIMESTAMP"),
    ),
)
SUITES = {suite.name: suite for suite in (STORY_SUITE, EVENT_SUITE, VIDEO_SUITE)}
CHECKPOINT = "bronze_to_silver"
VALIDATIONS = (
    ("hackernews_silver", "hackernews_expectations"),
    ("github_silver", "github_expectations"),
    ("youtube_silver", "youtube_expectations"),
)

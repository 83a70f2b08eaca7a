"""Profiles: what distinguishes one publisher's command references from another's."""

from __future__ import annotations

import importlib
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text
from ..operators.fields import RELATED

#: Labels of fields, and what they mean.
BASE = {name: name for name in ("Function", "Format", "Parameters", "Views", "Usage Guidelines", "Examples", *RELATED)}
NUMBERED = {"Default Level": "Default Level", "Task Name and Operations": "Task Name and Operations", "Example": "Examples"}
LABELLED = {
    "Description": "Function",
    "Syntax": "Format",
    "Syntax Description": "Parameters",
    "Command Modes": "Views",
    "Command Mode": "Views",
    "Usage Guidelines": "Usage Guidelines",
    "Example": "Examples",
    "Command Default": "Defaults",
    "Defaults": "Defaults",
    "Command History": "History",
    "Related Commands": "Related Commands",
}


@dataclass(frozen=True)
class Profile:
    """The values that the plan of a reference depends on; `replace` derives one profile from another."""

    name: str
    labels: dict[str, str] = field(default_factory=lambda: dict(BASE))
    header: float = 50.0
    footer: float = 40.0
    label_size: float = 11.5
    numbered: bool = True
    heading_size: float = 12.0
    heading_left: float = 0.24
    heading_match: str = "equal"
    bookmark_titles: bool = False
    excluded: tuple[tuple[str | None, str | None], ...] = ()
    keyword: str = "bold"
    conditions: tuple[str, ...] = ()
    inverse: tuple[str, ...] = ()
    split_inverse: bool = False
    prompt: str = r"(?!)"
    caption: str = "#"
    unlabelled: bool = False
    body_left: float = 0.0
    no_parameters: str | None = None
    capital_titles: tuple[str, ...] | None = None

    def label(self) -> Column:
        """The field that a line's label begins, else null."""
        known = F.create_map(*[F.lit(x) for pair in self.labels.items() for x in pair])
        return F.when((F.col("kind") == "line") & F.col("bold") & (F.col("size") >= self.label_size), F.try_element_at(known, text.strip(F.col("text"))))

    def same_title(self, title: Column, line: Column) -> Column:
        """Whether a printed heading is a bookmark's."""
        if self.heading_match == "equal":
            return title == line
        bare = lambda c: F.replace(c, F.lit(" "), F.lit(""))
        return (title == line) | title.startswith(F.concat(line, F.lit(" "))) | (bare(title) == bare(line))


numbered = Profile(
    "huawei",
    labels=BASE | NUMBERED,
    header=75.0,
    footer=45.0,
    conditions=("For ",),
    inverse=("undo",),
    prompt=r"^(?:(?:<[^<>\s]+>|\[[~*]?[^\[\]\s]+\])\s*\S|(?:<>|\[\])\s+[A-Za-z])",
)
labelled = Profile(
    "cisco",
    labels=BASE | LABELLED,
    numbered=False,
    heading_size=14.0,
    label_size=10.0,
    keyword="upright",
    inverse=("no", "default", "no-match"),
    prompt=r"^(?:[\w./:-]+)?(?:\([^\n)]*\))?[#>]\s*\S",
    caption="!",
    unlabelled=True,
)
PROFILES = {
    p.name: p
    for p in (
        numbered,
        replace(numbered, name="cloudengine"),
        replace(numbered, name="campus-switch", bookmark_titles=True, excluded=(("1", None), (None, "Command Support"), ("8.2.1", "MLD Configuration Commands"))),
        replace(numbered, name="ne40e"),
        replace(numbered, name="ne40e-rendered", bookmark_titles=True, header=0.0, footer=0.0),
        labelled,
        replace(
            labelled,
            name="cisco-catalyst",
            footer=55.0,
            heading_match="loose",
            split_inverse=True,
            body_left=125.0,
            no_parameters=r"This command has no (?:arguments or keywords|keywords or arguments)\.",
            capital_titles=("Keepalive (template)",),
        ),
    )
}


def profile(name: str) -> Profile:
    """A profile by name, or by module:NAME; anything but a Profile is refused."""
    if name in PROFILES:
        return PROFILES[name]
    module, _, attribute = name.partition(":")
    found = getattr(importlib.import_module(module), attribute, None) if attribute else None
    if not isinstance(found, Profile):
        raise ValueError(f"no profile {name}; known are {', '.join(PROFILES)}, or module:NAME of a Profile")
    return found

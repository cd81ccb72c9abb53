"""Rule specifications: parsed once on the driver, turned into Columns later.

A rule is pure configuration (a few strings); nothing here touches data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any, NamedTuple

# Fixed values, which compatible rule files and error entries rely on: the two
# kinds of rule, the keys of a rule mapping, and the default name "<kind>_<column>".
NOT_NULL, REGEX = "not_null", "regex"
SUPPORTED_RULE_TYPES = frozenset((NOT_NULL, REGEX))
#: A check that the library adds itself where malformed records were kept: its column, their raw text, must be NULL.
WELL_FORMED = "well_formed"
_KIND, _COLUMN, _PATTERN, _NAME = "rule_type", "column", "pattern", "rule_name"


class Rule(NamedTuple):
    """One check of one column. ``label`` is a name given by hand; ``name`` always has one."""

    kind: str
    column: str
    pattern: str | None = None
    label: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}" if self.label is None else self.label

    def spec(self) -> dict[str, str]:
        """The mapping that ``read_rule`` turns into this rule."""
        parts = {_KIND: self.kind, _COLUMN: self.column, _PATTERN: self.pattern, _NAME: self.label}
        return {key: value for key, value in parts.items() if value is not None}


def _faults(spec: Mapping[str, Any]) -> list[str]:
    """Everything that keeps a mapping from being a rule."""
    faults = [f"it has no '{key}'" for key in (_KIND, _COLUMN) if key not in spec]
    kind = spec.get(_KIND, NOT_NULL)
    if kind not in SUPPORTED_RULE_TYPES:
        faults.append(f"Unknown rule type '{kind}' (known: {', '.join(sorted(SUPPORTED_RULE_TYPES))})")
    elif kind == REGEX and not spec.get(_PATTERN):
        # Without a pattern it would let every value pass.
        faults.append(f"a {REGEX} rule needs a '{_PATTERN}'")
    return faults


def read_rule(spec: Mapping[str, Any] | Rule) -> Rule:
    """A rule from its mapping; a mapping with faults is refused with all of them named."""
    if isinstance(spec, Rule):
        return spec
    faults = _faults(spec)
    if faults:
        raise ValueError(f"Not a rule, {dict(spec)}: {'; '.join(faults)}")
    return Rule(spec[_KIND], spec[_COLUMN], spec.get(_PATTERN), spec.get(_NAME))


def read_rules(specs: Iterable[Mapping[str, Any] | Rule]) -> list[Rule]:
    return list(map(read_rule, specs))


def not_null(column: str, label: str | None = None) -> Rule:
    return Rule(NOT_NULL, column, label=label)


def regex(column: str, pattern: str, label: str | None = None) -> Rule:
    return read_rule(Rule(REGEX, column, pattern, label).spec())


def well_formed(column: str, label: str = "malformed_record") -> Rule:
    """Fails for records whose raw text a reader kept in ``column``."""
    return Rule(WELL_FORMED, column, label=label)

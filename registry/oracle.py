"""All checks of the registered queries."""

from __future__ import annotations

from registry import checks, more_checks, time_checks

CHECKS: dict[str, str] = checks.CHECKS | time_checks.CHECKS | more_checks.CHECKS

"""Named settings of a run, read from any mapping of strings (an environment, a table, a file)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

#: What holds where a setting is absent or no number.
TOKENS_PER_DAY, VERIFY_USD, MONTH_USD, MODELS, VERIFIER = 2_000_000, 0.50, 10.00, (), ""
#: Dollars for a million tokens, read and written, of extraction and of verification.
EXTRACT_RATES, VERIFY_RATES = (0.30, 2.50), (1.25, 10.0)
_YES = ("1", "true", "yes")


def _number(raw: str, otherwise: float) -> float:
    try:
        return float(raw) if raw.strip() else otherwise
    except ValueError:
        return otherwise


def flag(settings: Mapping[str, str], name: str) -> bool:
    return settings.get(name, "").strip().lower() in _YES


@dataclass(frozen=True)
class Settings:
    """All of a run's settings but its scope."""

    mode: str = "staged"
    verify: bool = False
    approved_only: bool = False
    bodies: bool = False
    tokens_per_day: int = TOKENS_PER_DAY
    verify_usd: float = VERIFY_USD
    month_usd: float = MONTH_USD
    models: tuple[str, ...] = MODELS
    verifier: str = VERIFIER
    user_agent: str = "casewright/1.0"
    api_key: str | None = None
    endpoints: tuple[str, ...] = ()

    @classmethod
    def of(cls, settings: Mapping[str, str], configured: Mapping | None = None) -> Settings:
        """``settings`` first, then what ``configured`` (a parsed source file) says of models, then the defaults. A cap that
        is no number is the default; an endpoint list is comma-separated."""
        told = configured or {}
        split = lambda name: tuple(x.strip() for x in settings.get(name, "").split(",") if x.strip())
        section = lambda name: told.get(name) if isinstance(told.get(name), Mapping) else {}
        listed = tuple(m.strip() for m in section("extraction").get("models") or () if isinstance(m, str) and m.strip())
        model = section("verification").get("model")
        return cls(
            mode=settings.get("LAUNCH_MODE", "").strip().lower() or "staged",
            verify=flag(settings, "VERIFY_ENABLED"),
            approved_only=flag(settings, "PUBLISH_APPROVED_ONLY"),
            bodies=flag(settings, "FETCH_ARTICLE_BODY"),
            tokens_per_day=int(_number(settings.get("DAILY_TOKEN_CAP", ""), TOKENS_PER_DAY)),
            verify_usd=_number(settings.get("VERIFY_MAX_USD", ""), VERIFY_USD),
            month_usd=_number(settings.get("MONTHLY_MAX_USD", ""), MONTH_USD),
            models=split("MODELS") or listed or MODELS,
            verifier=settings.get("VERIFY_MODEL", "").strip() or (model.strip() if isinstance(model, str) else "") or VERIFIER,
            user_agent=settings.get("USER_AGENT", "") or "casewright/1.0",
            api_key=settings.get("API_KEY") or None,
            endpoints=split("ENDPOINTS"),
        )


def estimate_usd(tokens_in: int, tokens_out: int, rates: tuple[float, float] = EXTRACT_RATES) -> float:
    return round(tokens_in / 1e6 * rates[0] + tokens_out / 1e6 * rates[1], 6)


def illustrative_usd(characters: int, documents: int) -> float:
    """A rough cost before anything is asked: four characters a token, 400 tokens of prompt and 200 of answer a document."""
    return estimate_usd(characters // 4 + 400 * documents, 200 * documents)


def scope_label(states: frozenset[str] | None, lookback: int | None) -> str:
    where = ",".join(sorted(states)) if states else "all states"
    return f"{where}; {f'last {lookback}d' if lookback is not None else 'no window'}"


def token_cap(usd: float, rate: float = EXTRACT_RATES[1]) -> int:
    """The tokens that a budget buys at the rate of what is written, the dearer one, so that it is never passed."""
    return int(usd / rate * 1e6)

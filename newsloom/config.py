"""Run parameters."""

from __future__ import annotations

from dataclasses import dataclass

# The default markets, as language-COUNTRY, in run order.
MARKETS = (
    "es-AR", "en-AU", "de-AT", "nl-BE", "fr-BE", "pt-BR", "en-CA", "fr-CA",
    "es-CL", "da-DK", "fi-FI", "fr-FR", "de-DE", "zh-HK", "en-IN", "en-ID",
    "it-IT", "ja-JP", "ko-KR", "en-MY", "es-MX", "nl-NL", "en-NZ", "no-NO",
    "zh-CN", "pl-PL", "en-PH", "ru-RU", "en-ZA", "es-ES", "sv-SE", "fr-CH",
    "de-CH", "zh-TW", "tr-TR", "en-GB", "en-US", "es-US",
)

SCHEMA_VERSION = "1.1"


@dataclass(frozen=True)
class Settings:
    """What a run may vary; the defaults are the stored contract's."""

    markets: tuple[str, ...] = MARKETS
    min_content_length: int = 300
    max_content_length: int = 500_000
    require_meta_lang: bool = True
    key_buckets: int = 32  # of the key index of a table that is new

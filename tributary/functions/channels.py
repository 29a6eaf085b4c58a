"""Channel grouping as native Column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT_BRAND_REGEX

# --- fixed values (must equal the reference's taxonomy) ------------------------
# The 19 canonical channel names, in the reference's order.
CHANNELS = (
    "Cross-network", "Paid Search Brand", "Paid Search Non-Brand",
    "Paid Shopping", "Paid Social", "Paid Video", "Display",
    "Organic Search", "Organic Shopping", "Organic Social", "Organic Video",
    "Email", "SMS", "Affiliate", "Audio", "Mobile Push", "Referral", "Direct", "Unknown",
)
# Feature-column order of the data-driven model (the 19 flags, as the training
# table lists them).
FEATURE_CHANNELS = (
    "Paid Search Brand", "Paid Search Non-Brand", "Paid Social", "Organic Social",
    "Organic Search", "Paid Video", "Organic Video", "Display", "Email",
    "Referral", "Affiliate", "Direct", "Cross-network", "Paid Shopping",
    "Organic Shopping", "SMS", "Audio", "Mobile Push", "Unknown",
)
# LIKE patterns: an underscore stands for any character ("Performance Max").
CROSS_NETWORK_CAMPAIGN_PATTERNS = ("%pmax%", "%performance_max%", "%demand_gen%", "%demand-gen%")
PAID_SEARCH_MEDIUMS = ("cpc", "ppc", "paidsearch")
VIDEO_SOURCES_PAID = ("youtube", "vimeo")
PAID_VIDEO_MEDIUMS = ("cpc", "ppc", "cpv", "cpm", "paid")
SOCIAL_SOURCES = ("facebook", "instagram", "tiktok", "pinterest", "linkedin", "x", "twitter", "snapchat", "reddit")
PAID_SOCIAL_MEDIUMS = ("cpc", "ppc", "paid", "paidsocial")
DISPLAY_MEDIUMS = ("display", "banner", "cpm", "expandable", "interstitial")
VIDEO_SOURCES_ORGANIC = ("youtube", "vimeo", "dailymotion")
EMAIL_MEDIUMS = ("email", "e-mail", "mail", "newsletter")
AUDIO_MEDIUMS = ("audio", "podcast")
PUSH_MEDIUMS = ("push", "mobile-push", "app-push")
UNKNOWN_SOURCE_PATTERNS = ("%data deleted%", "%<Other>%")
# Stand-alone 8-way taxonomy: (medium list, channel) checked in order, then
# `source / medium`.
CHANNELS_8 = ("Paid Search", "Organic Search", "Social", "Email", "Display", "Referral", "Affiliate", "Direct")
# ------------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _like_any(c: Column, patterns) -> Column:
    cond = None
    for p in patterns:
        term = c.like(p)
        cond = term if cond is None else (cond | term)
    return cond


def channel_grouping_19(medium, source, campaign, brand_regex: str = DEFAULT_BRAND_REGEX) -> Column:
    """Ordered 19-way CASE: first matching rule wins.

    Arguments are the already-defaulted session columns (medium defaulted to
    ``(none)``, source to ``(direct)``, campaign to ``''``). String tests are
    case-sensitive except where the rule lowers the value.
    """
    medium, source, campaign = _col(medium), _col(source), _col(campaign)
    lc = F.lower(campaign)
    ls = F.lower(source)
    m = F.coalesce(medium, F.lit(""))
    paid_search = m.isin(*PAID_SEARCH_MEDIUMS)
    return (
        F.when(_like_any(lc, CROSS_NETWORK_CAMPAIGN_PATTERNS), "Cross-network")
        .when(paid_search & (ls.contains("shopping") | lc.contains("shopping")), "Paid Shopping")
        .when(paid_search & F.lower(F.coalesce(campaign, F.lit(""))).rlike(brand_regex), "Paid Search Brand")
        .when(paid_search, "Paid Search Non-Brand")
        .when(ls.isin(*VIDEO_SOURCES_PAID) & m.isin(*PAID_VIDEO_MEDIUMS), "Paid Video")
        .when(ls.isin(*SOCIAL_SOURCES) & m.isin(*PAID_SOCIAL_MEDIUMS), "Paid Social")
        .when(m.isin(*DISPLAY_MEDIUMS), "Display")
        .when(ls.contains("shopping"), "Organic Shopping")
        .when(ls.isin(*VIDEO_SOURCES_ORGANIC), "Organic Video")
        .when(ls.isin(*SOCIAL_SOURCES) | F.lower(m).contains("social"), "Organic Social")
        .when(m == "organic", "Organic Search")
        .when(m.isin(*EMAIL_MEDIUMS), "Email")
        .when(m == "sms", "SMS")
        .when(m == "affiliate", "Affiliate")
        .when(m.isin(*AUDIO_MEDIUMS), "Audio")
        .when(m.isin(*PUSH_MEDIUMS), "Mobile Push")
        .when(m == "referral", "Referral")
        .when(F.coalesce(medium, F.lit("(none)")).isin("(none)", ""), "Direct")
        .when(_like_any(F.coalesce(source, F.lit("")), UNKNOWN_SOURCE_PATTERNS), "Unknown")
        .otherwise("Unknown")
    )


def channel_grouping_8(medium, source) -> Column:
    """Stand-alone taxonomy: 8 medium rules, else ``source / medium``.

    Arguments are the raw (possibly NULL) resolved source and medium.
    """
    medium, source = _col(medium), _col(source)
    m = F.coalesce(medium, F.lit("(none)"))
    return (
        F.when(m.isin(*PAID_SEARCH_MEDIUMS), "Paid Search")
        .when(m == "organic", "Organic Search")
        .when(F.lower(F.coalesce(medium, F.lit(""))).contains("social"), "Social")
        .when(m == "email", "Email")
        .when(m.isin("display", "banner"), "Display")
        .when(m == "referral", "Referral")
        .when(m == "affiliate", "Affiliate")
        .when(m.isin("(none)", ""), "Direct")
        .otherwise(F.concat(F.coalesce(source, F.lit("(direct)")), F.lit(" / "), m))
    )


def feature_name(channel: str) -> str:
    """``'Paid Search Non-Brand'`` -> ``'has_paid_search_non_brand'``."""
    return "has_" + channel.lower().replace("-", "_").replace(" ", "_")


def channel_list() -> list[str]:
    return list(CHANNELS)

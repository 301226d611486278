"""Mapping a file's header to the standard columns."""

from __future__ import annotations

# Other names of the standard columns, in order of preference.
COLUMN_ALIASES = {
    "name": (
        "company_name", "company name", "input-company-name", "input_company_name", "account_name", "account name",
        "organization", "organisation", "firm", "name",
    ),
    "website": (
        "website", "domain", "company_domain", "company domain", "input-company-domain", "input_company_domain",
        "web", "url", "homepage", "company_url", "site", "web_address",
    ),
    "linkedin": (
        "linkedin", "linkedin_url", "linkedin url", "linkedin_profile", "li_url", "linked_in",
    ),
    "description": (
        "description", "company_description", "about", "overview", "summary", "bio",
    ),
    "industry": (
        "industry", "sector", "vertical", "market", "industry_type",
    ),
    "size": (
        "size", "company_size", "employee_count", "employees", "headcount", "staff_count", "num_employees",
        "number_of_employees",
    ),
    "email": (
        "email", "email_address", "contact_email", "company_email", "e_mail",
    ),
    "phone": (
        "phone", "phone_number", "telephone", "contact_phone", "tel", "mobile", "contact_number",
    ),
    "facebook": (
        "facebook", "facebook_url", "fb", "facebook_page",
    ),
    "twitter": (
        "twitter", "twitter_url", "twitter_handle", "x_url", "x_handle",
    ),
    "instagram": (
        "instagram", "instagram_url", "ig", "instagram_handle",
    ),
    "ceo": (
        "ceo", "chief_executive_officer", "chief executive", "ceo_name", "executive",
    ),
    "founder": (
        "founder", "co_founder", "co-founder", "founders", "founding_member",
    ),
}


def plain(name: str) -> str:
    """Lower case, trimmed, hyphens and blanks as underscores."""
    return name.strip().lower().translate(str.maketrans("- ", "__"))


def aliases(column: str) -> list[str]:
    return [plain(a) for a in COLUMN_ALIASES[column]]


def detect_column(header: list[str], column: str) -> str | None:
    """The header's name for a column: an alias word for word, in order of preference, else the first that has one in it."""
    by_plain: dict[str, str] = {}
    for raw in header:
        by_plain.setdefault(plain(raw), raw)
    wanted = aliases(column)
    exact = next((by_plain[a] for a in wanted if a in by_plain), None)
    return exact or next((raw for raw in header if any(a in plain(raw) for a in wanted)), None)


def column_mapping(header: list[str]) -> dict[str, str]:
    """Raw name to standard column. Where two columns pick one raw name, the one later in the table gets it."""
    picked = {column: detect_column(header, column) for column in COLUMN_ALIASES}
    return {raw: column for column, raw in picked.items() if raw is not None}

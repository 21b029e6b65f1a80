"""URL expressions over free-text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: hosts of the drive that needs a login, known image suffixes
DRIVE_HOSTS = ("feishu.cn", "larksuite.com", "feishu.com")
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "gif", "webp", "bmp", "heic")

URL = r"""(?i)https?://[^\s,;|\]"'>]+"""


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def extract_urls(text: Column | str) -> Column:
    """Distinct URLs of a cell in order of appearance, trailing punctuation cut."""
    found = F.regexp_extract_all(_col(text), F.lit(f"({URL})"), F.lit(1))
    cut = F.transform(found, lambda u: F.regexp_replace(u, r"[.,);\]]+$", ""))
    return F.array_distinct(F.filter(cut, lambda u: u != ""))


def first_image_url(*columns: str) -> Column:
    """First URL of the first cell that holds one."""
    cells = [
        F.nullif(F.regexp_extract(F.trim(c), r"(?i)(https?://[^\s,;]+)", 1), F.lit("")) for c in columns
    ]
    return F.coalesce(*cells)


def url_host(url: Column | str) -> Column:
    return F.lower(F.try_parse_url(_col(url), F.lit("HOST")))


def needs_login(url: Column | str) -> Column:
    host = url_host(url)
    found = F.contains(host, F.lit(DRIVE_HOSTS[0]))
    for marker in DRIVE_HOSTS[1:]:
        found = found | F.contains(host, F.lit(marker))
    return F.coalesce(found, F.lit(False))


def image_extension(url: Column | str) -> Column:
    """Suffix of the URL path when it is a known image suffix, else ``.jpg``."""
    path = F.coalesce(F.try_parse_url(_col(url), F.lit("PATH")), F.lit(""))
    suffix = F.lower(F.regexp_extract(path, r"\.([^.]*)$", 1))
    return (
        F.when(suffix == "jpeg", ".jpg")
        .when(suffix.isin(*IMAGE_SUFFIXES), F.concat(F.lit("."), suffix))
        .otherwise(".jpg")
    )


def url_key(url: Column | str, prefix: str) -> Column:
    """Stable object name of a source URL."""
    digest = F.substring(F.sha2(_col(url), 256), 1, 32)
    return F.concat(F.lit(f"{prefix}/by-source/"), digest, image_extension(url))

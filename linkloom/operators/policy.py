"""Deny policy: domains and file suffixes that the link stage rejects."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Domains that are not taken (fixed values).
DENIED_DOMAINS = (
    "aapks.com", "bandcamp.com", "battleforthenet.com", "deviantart.com", "discord.gg",
    "dlapkandroid.org", "ebay.com", "edealinfo.com", "erome.com", "facebook.com", "flic.kr",
    "flickr.com", "gfycat.com", "giphy.com", "github.com", "google.com", "gunprime.com",
    "gyazo.com", "hotdealstar.com", "imgflip.com", "imgur.com", "instagram.com",
    "magaimg.net", "pinterest.com", "pornhub.com", "redd.it", "reddit.com", "redditmedia.com",
    "reddituploads.com", "roanoke.com", "rollingstone.com", "sli.mg", "soundcloud.com",
    "spotify.com", "spotrac.com", "strawpoll.me", "streamable.com", "timeanddate.com",
    "twimg.com", "twitch.tv", "twitter.com", "vimeo.com", "voyagefusion.com", "walmart.com",
    "wikipedia.org", "xkcd.com", "youtu.be", "youtube.com", "youtubedoubler.com",
)
# Listed with a subdomain, so only the very same host is meant (fixed values).
DENIED_HOSTS = (
    "itunes.apple.com", "video.google.com",
)
# Endings that are not taken (fixed values).
DENIED_SUFFIXES = (
    ".3gp", ".7z", ".ai", ".aif", ".apk", ".app", ".avi", ".bin", ".bmp", ".bz2", ".css",
    ".csv", ".dat", ".deb", ".dmg", ".doc", ".docx", ".exe", ".gif", ".gifv", ".gz", ".iso",
    ".jar", ".jpeg", ".jpg", ".js", ".log", ".mid", ".midi", ".mkv", ".mov", ".mp3", ".mp4",
    ".mpeg", ".mpg", ".ogg", ".ogv", ".otf", ".pdf", ".pkg", ".png", ".pps", ".ppt", ".pptx",
    ".psd", ".py", ".qt", ".ram", ".rar", ".sql", ".svg", ".swf", ".tar", ".tar.gz", ".tgz",
    ".tiff", ".ttf", ".txt", ".wav", ".webm", ".wma", ".wmv", ".xml", ".xz", ".zip",
)


@dataclass(frozen=True)
class DenyPolicy:
    """A policy small enough to live in the plan as literals.

    ``domains`` deny a host and all hosts below it, ``hosts`` that host only.
    """

    domains: tuple[str, ...] = DENIED_DOMAINS
    hosts: tuple[str, ...] = DENIED_HOSTS
    suffixes: tuple[str, ...] = DENIED_SUFFIXES
    min_length: int = 10


def policy_table(spark: SparkSession, policy: DenyPolicy = DenyPolicy()) -> DataFrame:
    """The domain part as a table ``(pattern, match_kind)``."""
    kinds = ["registered"] * len(policy.domains) + ["host"] * len(policy.hosts)
    return spark.createDataFrame(
        pa.table({"pattern": [*policy.domains, *policy.hosts], "match_kind": kinds})
    )

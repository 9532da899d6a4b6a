"""Everything that is particular to one site, in one argument."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from pagetables.functions.dates import date_part_text
from pagetables.functions.text import remove_tags, strip
from pagetables.operators.html import Selector, by_class, by_class_part, by_id, by_tag, meta

Step = Callable[[Column], Column]


@dataclass(frozen=True)
class CleaningRules:
    scam_phrases: tuple[str, ...] = ()
    cutoff_markers: tuple[str, ...] = ()


@dataclass(frozen=True)
class LinkRule:
    """Patterns are searched anywhere in the resolved URL. `regions` are class names on or above the anchor."""

    name: str
    action: str  # parse, follow or drop
    allow: tuple[str, ...] = ()
    deny: tuple[str, ...] = ()
    deny_domains: tuple[str, ...] = ()
    regions: tuple[str, ...] = ()
    anchor_class_part: str | None = None


@dataclass(frozen=True)
class Selectors:
    title: tuple[Selector, ...]
    check_date: tuple[Selector, ...]
    date: tuple[Selector, ...]
    content: tuple[Selector, ...]  # the first one with any non-blank text is used; the last one is the fallback
    lead: tuple[Selector, ...]
    author: tuple[Selector, ...]
    keywords: tuple[Selector, ...]
    image: tuple[Selector, ...]
    id: tuple[Selector, ...]

    def all(self) -> tuple[Selector, ...]:
        return (
            self.title + self.check_date + self.date + self.content + self.lead + self.author + self.keywords + self.image + self.id
        )


# Per-field steps applied to each candidate; candidates that are empty afterwards do not count.
DEFAULT_STEPS: dict[str, tuple[Step, ...]] = {
    "title": (strip, remove_tags),
    "date": (strip, date_part_text),
    "content": (remove_tags, strip),
    "author": (strip, remove_tags),
    "image_url": (strip,),
    "id": (strip,),
}


@dataclass(frozen=True)
class SiteProfile:
    selectors: Selectors
    link_rules: tuple[LinkRule, ...] = ()
    deny_extensions: tuple[str, ...] = ()
    allowed_domains: tuple[str, ...] = ()
    scope: str = ""
    section_mark: str = ""
    homepages: tuple[str, ...] = ()
    start_urls: tuple[str, ...] = ()
    max_depth: int = 5
    days_limit: int = 3
    rules: CleaningRules = CleaningRules()
    keep_lead: bool = False
    steps: dict[str, tuple[Step, ...]] = field(default_factory=lambda: dict(DEFAULT_STEPS))

    def regions(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(region for rule in self.link_rules for region in rule.regions))


# Link targets that are files, not pages.
FILE_EXTENSIONS = (
    "7z 7zip bz2 rar tar tar.gz xz zip "
    "mng pct bmp gif jpg jpeg png pst psp tif tiff ai drw dxf eps ps svg cdr ico webp "
    "mp3 wma ogg wav ra aac mid au aiff "
    "3gp asf asx avi mov mp4 mpg qt rm swf wmv m4a m4v flv webm "
    "xls xlsm xlsx xltm xltx potm potx ppt pptm pptx pps doc docb docm docx dotm dotx odt ods odg odp "
    "css pdf exe bin rss dmg iso apk jar sh rb js hta bat cpl msi msp py"
).split()

# Page hooks, link patterns, hosts and limits of the default news site.
NEWS_SITE = SiteProfile(
    selectors=Selectors(
        title=(by_tag("h1"),),
        check_date=(by_class("ods-m-date-authorship__publication"), by_class_part("span", "date")),
        date=(by_class("ods-m-date-authorship__publication"), by_class_part("span", "date")),
        content=(by_class("hyphenate"), by_tag("p")),
        lead=(by_id("lead"),),
        author=(by_class("ods-m-author-xl__name-link"), by_class("ods-m-author-xl__name"), by_class("authorName")),
        keywords=(meta("name", "keywords"),),
        image=(meta("property", "og:image"),),
        id=(meta("name", "data-story-id"),),
    ),
    link_rules=(
        LinkRule(
            "skip", "drop",
            allow=(r"archiwum", r"20\d\d-", r"pogoda", r"sport"),
            deny_domains=("przegladsportowy.onet.pl",),
        ),
        LinkRule(
            "article", "parse",
            allow=(r"wiadomosci\.onet\.pl/[a-z0-9-]+/[a-z0-9-]+/[a-z0-9]+",),
            deny=(r"#", r"autorzy", r"oferta", r"partner", r"reklama", r"promocje", r"sponsored"),
            regions=("ods-c-card-wrapper", "ods-o-card"),
        ),
        LinkRule(
            "category", "follow",
            allow=(r"wiadomosci\.onet\.pl/[a-z0-9-]+$",),
            deny=(r"szukaj", r"autorzy", r"redakcja", r"pogoda"),
        ),
        LinkRule("pagination", "follow", allow=(r"wiadomosci.onet.pl",), anchor_class_part="next"),
    ),
    deny_extensions=tuple(FILE_EXTENSIONS),
    allowed_domains=("onet.pl",),
    scope="onet.pl",
    section_mark="wiadomosci",
    homepages=("https://www.onet.pl", "http://www.onet.pl", "https://onet.pl"),
    start_urls=("https://wiadomosci.onet.pl/",),
    max_depth=5,
    days_limit=3,
)

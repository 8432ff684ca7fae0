"""Row shapes of the tables the jobs read and write, as DDL strings."""

ARTICLES = (
    "id bigint, title string, rephrased_article binary, scraped_at bigint, "
    "rephrased_title string, headline_verified int"
)

ARTICLE_COLUMNS = [c.split()[0] for c in ARTICLES.split(", ")]

# Stored articles are partitioned by the day they were scraped on, counted from the epoch.
DAY_COLUMN = "scraped_day"
DAY_S = 86400

# What one model call leaves behind: its text, or the error of that row.
ANSWER = "struct<text:string,error:string>"

# One rejected text on the way to a decision.
ATTEMPT = "struct<stage:string,generated:string,reason:string>"

DECISION_COLUMNS = [
    "id",
    "headline",
    "verified",
    "outcome",
    "stage",
    "reason",
    "error",
    "attempts",
]

DECISIONS = (
    "id bigint, headline string, verified int, outcome string, stage string, "
    f"reason string, error string, attempts array<{ATTEMPT}>"
)

REJECTIONS = "ts timestamp, id bigint, stage string, generated string, reason string"

QUARANTINE = "id bigint, cause string, rephrased_article binary"

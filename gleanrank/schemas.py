"""Column layouts shared by readers and writers."""

CAPTURES = "crawl string, url string, status string, filename string"
RECORDS = "file string, block bigint, pos bigint, uri string, header string, body string"
EXTRACTS = RECORDS + ", wet_pos bigint, batch bigint"
CORPUS = "id bigint, url string, title string, text string"
DOC_FREQ = "term string, df bigint"
DOC_LENGTHS = "doc_id bigint, doc_len bigint"
POSTINGS = "doc_id bigint, term string, tf bigint, doc_len bigint"
STATS = "n_docs bigint, avg_len double"
HITS = "rank bigint, doc_id bigint, score double"
RANKING = "doc_id bigint, score double"
CAPTURE_INDEX = "pos bigint, " + CAPTURES + ", host_key string"


def names(layout: str) -> list[str]:
    """Column names of a layout."""
    return [column.split()[0] for column in layout.split(", ")]

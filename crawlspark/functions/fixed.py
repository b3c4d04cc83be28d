"""Fixed values. Results only agree with earlier crawls if these stay as they are."""

# Words in a link's text that mark a document.
DOCUMENT_WORDS = [
    "pdf", "download", "document", "report", "manual",
    "guide", "handbook", "publication", "brochure",
    "leaflet", "circular", "notice", "code", "standard",
]

# Words in a link's text that mark a web page instead.
WEB_PAGE_WORDS = ["html", "webpage", "page"]

# URL forms that usually lead to a document, matched without case.
DOCUMENT_URL_PATTERNS = [
    r"/download/",
    r"/documents?/",
    r"/files?/",
    r"/publications?/",
    r"/resources?/",
    r"/attachments?/",
    r"\.pdf\?",
    r"\.pdf&",
    r"filetype=pdf",
    r"format=pdf",
    r"type=pdf",
]

# Words that mark an archive section.
ARCHIVE_WORDS = [
    "archive", "archives", "historical", "history", "past",
    "previous", "old", "legacy", "back-issues", "publications",
]

# A year that stands alone.
YEAR_PATTERN = r"\b(19|20)\d{2}\b"

# Terms to send to a site's own search, and the hints in a search input.
SEARCH_TERMS = [
    "PDF", "document", "publication", "report", "manual",
    "guide", "handbook", "circular", "notice", "code",
]
SEARCH_TERM_LIMIT = 3
SEARCH_INPUT_TYPES = ["search", "text"]
SEARCH_INPUT_HINTS = ["search", "query", "q", "keyword"]

# Signs of scripting, and the count above which a page needs a browser.
SCRIPT_SIGNS = ["<script", "javascript:", "onclick=", "onload="]
SCRIPT_LIMIT = 10

# Hosts that are always crawled (part of the host name is enough).
ALWAYS_ALLOWED_HOSTS = [
    "gov.hk", "labour.gov.hk", "bd.gov.hk", "fehd.gov.hk",
    "epd.gov.hk", "fsd.gov.hk", "landsd.gov.hk", "devb.gov.hk",
]

# Host endings of government sites.
GOVERNMENT_SUFFIXES = [
    "gov.hk", "labour.gov.hk", "bd.gov.hk", "fehd.gov.hk", "epd.gov.hk",
    "fsd.gov.hk", "landsd.gov.hk", "devb.gov.hk", "hkfsd.gov.hk", "info.gov.hk",
    "had.gov.hk", "td.gov.hk", "immd.gov.hk", "ird.gov.hk", "customs.gov.hk",
]

# Sitemap addresses of a host, in the order they are tried.
SITEMAP_LOCATIONS = [
    "https://{host}/sitemap.xml",
    "https://{host}/sitemap_index.xml",
    "https://{host}/sitemaps.xml",
    "http://{host}/sitemap.xml",
]

# Parts of an error text that make a retry worthwhile.
RETRYABLE_ERRORS = [
    "timeout", "connection", "network", "temporary", "server error",
    "500", "502", "503", "504", "429",
]
MAX_ATTEMPTS = 3

# Entities replaced in page text, in this order.
TEXT_ENTITIES = [
    ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"),
    ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
]

# Names that some file systems keep for devices.
DEVICE_NAMES = [
    "CON", "PRN", "AUX", "NUL",
    "COM1", "COM2", "COM3", "COM4", "COM5", "COM6", "COM7", "COM8", "COM9",
    "LPT1", "LPT2", "LPT3", "LPT4", "LPT5", "LPT6", "LPT7", "LPT8", "LPT9",
]

# Limits of document checks.
MIN_DOCUMENT_BYTES = 100
TRAILER_WINDOW = 1024
MAX_DOCUMENT_MB = 50
FILE_NAME_LIMIT = 100
PORTABLE_NAME_LIMIT = 255

# Outcome texts.
ERROR_BAD_URL = "URL does not point to a valid PDF file"
ERROR_BAD_CONTENT = "Downloaded content is not a valid PDF file"
ERROR_NOT_SAVED = "Failed to save file locally"
ERROR_NETWORK = "Network error: {error}"
ERROR_STATUS = "HTTP {status}"
ERROR_TOO_LARGE = "File too large ({megabytes}MB), skipping"
ERROR_DOWNLOAD = "Download failed for {url}: {error}"
ERROR_ATTEMPTS = "Failed after {attempts} attempts: {error}"
ERROR_UNKNOWN = "Unknown error"

# How a script names a document, and what a viewer's address holds.
SCRIPT_PATH = r"""(?i)["']([^"']*\.pdf[^"']*)["']"""
VIEWER_ADDRESS = r"(?i)viewer\.html|pdfjs"

# Characters that portable names do without.
RESERVED_CHARACTERS = r'[<>:"/\\|?*]'
CONTROL_CHARACTERS = r"[\x00-\x1f\x7f-\x9f]"

# Patterns of the Markdown seed list.
MARKDOWN_HEADER = r"^##\s+\d+\.\s+(.+?)(?:\s*\([^)]+\))?\s*:\s*$"
MARKDOWN_URL = r"https?://[^\s\)]+"
MARKDOWN_MAX_DEPTH = 3
MARKDOWN_MAX_PAGES = 500

# Defaults of a department in a YAML configuration.
DEFAULT_MAX_DEPTH = 3
DEFAULT_MAX_PAGES = 1000

# Lines of the text report; braces hold the values.
REPORT_HEAD = [
    "=" * 60,
    "{title}",
    "=" * 60,
    "Crawl completed at: {finished}",
    "Total duration: {minutes} minutes",
    "",
    "OVERALL STATISTICS",
    "-" * 30,
    "Total PDFs found: {found}",
    "Total PDFs downloaded: {downloaded}",
    "Total PDFs failed: {failed}",
    "Total PDFs skipped: {skipped}",
    "Success rate: {rate}%",
    "Total size downloaded: {megabytes} MB",
    "",
    "DEPARTMENT BREAKDOWN",
    "-" * 30,
]
REPORT_DEPARTMENT = [
    "",
    "{department}:",
    "  URLs crawled: {crawled}",
    "  PDFs found: {found}",
    "  PDFs downloaded: {downloaded}",
    "  PDFs failed: {failed}",
    "  PDFs skipped: {skipped}",
    "  Total size: {megabytes} MB",
    "  Duration: {minutes} minutes",
]
REPORT_RATE = "  Success rate: {rate}%"
REPORT_ERRORS = "  Errors encountered: {count}"
REPORT_ERROR = "    - {error}"
REPORT_MORE = "    ... and {more} more"
REPORT_FOOT = ["", "=" * 60]

# Columns of the CSV report, and decimals of its rounded ones.
CSV_COLUMNS = [
    "Department", "URLs_Crawled", "PDFs_Found", "PDFs_Downloaded", "PDFs_Failed",
    "PDFs_Skipped", "Total_Size_MB", "Duration_Minutes", "Success_Rate_%", "Error_Count",
]

# Issues and recommendations of a dry run.
ISSUE_RATE_LIMIT = "Rate limiting detected on {url}"
ISSUE_STATUS = "HTTP {status} error for {url}"
ISSUE_TIMEOUT = "Timeout accessing {url}"
ISSUE_CONNECTION = "Connection error for {url}"
ISSUE_OTHER = "Error accessing {url}: {error}"
ADVICE_BROWSER = "Enable browser automation for {department}"
ADVICE_RATE_LIMIT = "Increase delays for {department} to avoid rate limiting"
ADVICE_INACCESSIBLE = "Check inaccessible URLs for {department}"
ADVICE_MANY = "Consider running crawl in smaller batches due to large number of PDFs"
ADVICE_LONG = "Estimated crawl time is over 1 hour - consider parallel processing"

# Limits of the dry run's advice.
SECONDS_PER_DOCUMENT = 2.0
MANY_DOCUMENTS = 1000
LONG_RUN_SECONDS = 3600

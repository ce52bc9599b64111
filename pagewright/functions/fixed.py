"""Limits, lists, labels and patterns that results depend on.

Everything here is a constant of the export format or of the remote API and is kept
together, in natural order, as plain text.
"""
import mimetypes

# --- fixed values: archive limits ---
MAX_FILE_SIZE = 100 * 1024 * 1024
MAX_TOTAL_SIZE = 1024 * 1024 * 1024
MAX_FILES = 10000
MAX_NAME_LENGTH = 255

# --- fixed values: extensions ---
ALLOWED_EXTENSIONS = [
    ".html", ".md", ".txt", ".png", ".jpg", ".jpeg", ".gif",
    ".pdf", ".docx", ".doc", ".xlsx", ".xls", ".pptx", ".ppt",
]
IMAGE_EXTENSIONS = [".png", ".jpg", ".jpeg", ".gif", ".bmp", ".svg", ".webp"]
ATTACHMENT_LINK_EXTENSIONS = "png|jpg|jpeg|gif|pdf|docx?|xlsx?|pptx?|txt|zip|rar"

# --- fixed values: media types (standard library table plus the office formats) ---
DEFAULT_MIME = "application/octet-stream"
MIME_TYPES = {
    **mimetypes.MimeTypes(filenames=()).types_map[1],
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}

# --- fixed values: export naming and page furniture ---
EXPORT_PREFIX = "Confluence-space-export-"
EXPORT_SHORT_PREFIX = "Export-"
DEFAULT_SPACE_NAME = "Information Systems"
TITLE_PREFIX = r"^Information\s+Systems\s*:\s*"
GENERATOR_LINE = "Document generated by Confluence"
VENDOR_LINK_TEXT = "Atlassian"
VENDOR_DOMAIN = r"atlassian\.com"
HTML_MARKERS = r"<!DOCTYPE html|<html|<head|<body"
METADATA_KEYS = {
    "Key": "space_key",
    "Name": "space_name",
    "Description": "description",
    "Created by": "created_by",
}
SPACE_NAME_STOP_WORDS = ["Description", "##", "Available", "Pages:"]

# --- fixed values: content patterns ---
BREADCRUMB_ITEM = r"^\d+\.\s*\[([^\]]+)\]\(([^)]+)\)$"
BREADCRUMB_OPEN = r"^\d+\.\s*\[([^\]]+)$"
BREADCRUMB_CLOSE = r"^([^\]]*)\]\(([^)]+)\)$"
BREADCRUMB_BLOCK = r"^((?:\d+\.\s+\[.*?\](?:\([^)]+\)|\n\s+[^)]*\([^)]+\))\s*\n?)+)"
TITLE_SPAN = r'#\s*<span[^>]*id="title-text"[^>]*>\s*([^<]+)\s*</span>'
TITLE_SPAN_PREFIXED = r"#\s*<span[^>]*>\s*Information Systems\s*:\s*([^<]+)\s*</span>"
MARKDOWN_HEADER = r"#\s+(.+?)(?:\s*\{[^}]*\})?$"
CLEAN_HEADER = r"^#\s+(.+)$"
IMAGE_REF = r"!\s*\[([^\]]*)\]\(([^)]+)\)"
SRC_REF = r"src=[\"']([^\"']+)[\"']"
EMPTY_LINK = r"\[\s*\]\([^)]*\)"
PAGE_ID_IN_FILENAME = r"_(\d+)\.(html?|md)$"
UNSAFE_FILENAME_CHARS = r"[^a-zA-Z0-9\-_]"

# --- fixed values: remote documents ---
COLLECTION_COLOR = "#4E5C6E"
COLLECTION_ICON = "collection"
IMPORTED_FROM = "Imported from Confluence space: "
LOADING_STUB = "*Loading content with attachments...*"
SECTION_STUB = "This section contains the following documents:"
NO_CONTENT_STUB = "Content not available."
NOT_FOUND_STUB = "Content not found."
COLLECTION_STUB = "This is a collection page."
UNTITLED = "Untitled Document"

# --- fixed values: retry rules ---
MAX_RETRIES = 5
MAX_DELAY = 60.0
MAX_NETWORK_DELAY = 10.0
ATTACHMENT_TRIES = 3
DEFAULT_RETRY_AFTER = 60

# --- limits of this library ---
MAX_TITLE = 255  # characters of a document title that a dry run lets pass

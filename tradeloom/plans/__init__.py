"""Facts and daily reports built from conformed rows."""

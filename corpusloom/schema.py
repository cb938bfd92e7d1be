"""Schemas of packages and of the formats they are read from."""

META = "struct<package_id: string, title: string, created: string, year: int, edition: string, issue: string>"
PACKAGE = f"meta {META}, content array<string>"
MC4 = "text string, timestamp string, url string"
OSCAR = "content string, warc_headers struct<`warc-date`: string, `warc-target-uri`: string>"
WIKI = "text string, title string, url string"

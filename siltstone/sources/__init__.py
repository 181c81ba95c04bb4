"""Raw files: discovery, content hashes, nested JSON scans."""

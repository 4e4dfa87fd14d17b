"""Raw payloads, landed files, observation windows and table files."""

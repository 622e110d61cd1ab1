"""The jobs a user calls: imports, billing, linking, reports and building profiles."""

"""Files in and out: raw text, JSON, sheet exports, stored tables and XML."""

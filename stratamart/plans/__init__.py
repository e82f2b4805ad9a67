"""Layer definitions: raw feeds, staging, curated, marts, and their build order."""

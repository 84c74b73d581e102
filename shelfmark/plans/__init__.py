"""Multi-step jobs: state snapshots, point collections, refresh, embedding, retrieval."""

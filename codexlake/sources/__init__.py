"""Sources and sinks: curated lists, cached downloads, packaged books, feeds, reports."""

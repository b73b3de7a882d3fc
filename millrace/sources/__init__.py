"""Readers and writers: files, datasets, seeds, pages, sentence output, crawl state."""

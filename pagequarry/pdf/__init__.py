"""What a task needs to read one PDF file: objects, fonts and text runs, page layout."""

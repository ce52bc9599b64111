"""Wiki-export analytics on Spark: archives, page trees, markdown, attachments and sync plans as DataFrames."""

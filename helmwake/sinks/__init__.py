"""Writers: chunked episode files, metadata, progress, point clouds and reports."""

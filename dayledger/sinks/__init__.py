"""Writers: folders, published tables, the long view."""

"""Jobs that compose operators and exchange tables through storage."""

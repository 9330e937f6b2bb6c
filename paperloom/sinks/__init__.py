"""Writers. These run actions."""

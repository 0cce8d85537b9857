-- Daily panel: every sales row must find its calendar day; a price is optional.
WITH dated AS (
    SELECT s.*, c.* EXCEPT (d, day_num)
    FROM {sales} AS s
    JOIN {calendar} AS c USING (d, day_num)
)
SELECT dated.*, p.sell_price, isnull(p.sell_price) AS price_missing
FROM dated
LEFT JOIN {prices} AS p USING (store_id, item_id, wm_yr_wk)

"""Event registry and wire-format key maps of the tracker.

# ---------------------------------------------------------------------------
# FIXED VALUES. These must equal the tracker's wire format and the clean
# table layout for results to be right; they are data, stated in their
# natural order: (raw key, clean column) pairs.
# ---------------------------------------------------------------------------
"""

EVENT_TYPES = ["load", "leave", "timeout", "addCart", "removeCart", "purchase",
               "sendCoupon", "acceptCoupon", "discardCoupon", "enterCoupon",
               "sendAfAd", "acceptAf", "acceptAd"]

PAYLOAD_KEY = {"load": "load", "addCart": "cart", "removeCart": "remove_cart", "purchase": "purchase",
               "sendCoupon": "coupon_info", "acceptCoupon": "coupon_info", "discardCoupon": "coupon_info",
               "enterCoupon": "coupon_info", "sendAfAd": "afad_info", "acceptAf": "afad_info",
               "acceptAd": "afad_info"}

UNIVERSAL_KEYS = [("web_id", "web_id"), ("uuid", "uuid"), ("ga_id", "ga_id"), ("fb_id", "fb_id"),
                  ("timestamp", "timestamp"), ("coupon", "avivid_coupon")]

LOAD_KEYS = [("dv", "device"), ("ul", "url_last"), ("un", "url_now"), ("m_t", "meta_title"),
             ("i_l", "is_landing"), ("ps", "pageviews"), ("t_p_t", "time_pageview_total"),
             ("s_id", "session_id"), ("s_idl", "session_id_last"), ("l_c", "landing_count"),
             ("s_h", "scroll_height"), ("w_ih", "window_innerHeight"), ("c_c_t", "click_count_total"),
             ("mt_nm", "max_time_no_move_last"), ("mt_ns", "max_time_no_scroll_last"),
             ("mt_nc", "max_time_no_click_last"), ("mps", "max_pageviews"), ("mt_p", "max_time_pageview"),
             ("mt_p_t", "max_time_pageview_total"), ("ms_d", "max_scroll_depth"), ("i_ac", "is_addCart"),
             ("i_rc", "is_removeCart"), ("i_pb", "is_purchased_before")]

RECORD_KEYS = [("dv", "device"), ("ul", "url_last"), ("un", "url_now"), ("m_t", "meta_title"),
               ("s_h", "scroll_height"), ("w_ih", "window_innerHeight"), ("t_p", "time_pageview"),
               ("s_d", "scroll_depth"), ("s_d_", "scroll_depth_px"), ("c_c", "click_count"),
               ("c_c_t", "click_count_total"), ("t_nm", "time_no_move"), ("t_ns", "time_no_scroll"),
               ("t_nc", "time_no_click"), ("mt_nm", "max_time_no_move"), ("mt_ns", "max_time_no_scroll"),
               ("mt_nsa", "max_time_no_scroll_array"), ("mt_nda", "max_time_no_scroll_depth_array"),
               ("mt_nd", "max_time_no_scroll_depth"), ("mt_nd_", "max_time_no_scroll_depth_px"),
               ("mt_nc", "max_time_no_click"), ("i_l", "is_landing"), ("s_idl", "session_id_last"),
               ("s_id", "session_id"), ("ps", "pageviews"), ("t_p_t", "time_pageview_total"),
               ("t_p_tl", "time_pageview_total_last"), ("mps", "max_pageviews"), ("mt_p", "max_time_pageview"),
               ("mt_p_t", "max_time_pageview_total"), ("ms_d", "max_scroll_depth"),
               ("ms_d_p", "max_scroll_depth_page"), ("ms_d_pl", "max_scroll_depth_page_last"),
               ("mt_nml", "max_time_no_move_last"), ("mt_nsl", "max_time_no_scroll_last"),
               ("mt_ncl", "max_time_no_click_last"), ("ms_dl", "max_scroll_depth_last"),
               ("l_c", "landing_count"), ("i_ac", "is_addCart"), ("i_rc", "is_removeCart"),
               ("i_pb", "is_purchased_before")]

RECORD_PURCHASE_EXTRA = [("l_un", "landing_url"), ("l_ul", "landing_url_last")]

SEND_COUPON_KEYS = [("l_b", "lower_bound"), ("u_b", "upper_bound"), ("m_k", "model_keys"),
                    ("m_p", "model_parameters"), ("m_i", "model_intercept"), ("m_X", "model_X"),
                    ("c_i", "coupon_id"), ("c_c_t", "coupon_customer_type"), ("p_p", "prob_purchase")]

ENTER_COUPON_KEYS = [("s_id", "session_id"), ("code", "coupon_code")]

ACCEPT_COUPON_KEYS = [("p_p", "prob_purchase"), ("c_t", "coupon_title"), ("c_d", "coupon_description"),
                      ("c_c", "coupon_code"), ("c_st", "coupon_setTimer"), ("c_ty", "coupon_type"),
                      ("c_a", "coupon_amount"), ("c_c_t", "coupon_customer_type"),
                      ("c_c_m", "coupon_code_mode"), ("l_c", "link_code"), ("c_i", "coupon_id")]

AFAD_KEYS = [("l_b", "lower_bound"), ("p_p", "prob_purchase"), ("a_i", "ad_id"), ("w_t", "website_type")]

# click_info: (raw key, clean column, default)
CLICK_KEYS = [("s_id", "session_id", "_"), ("s_idl", "session_id_last", "_"), ("dv", "device", "-1"),
              ("ul", "url_last", "_"), ("un", "url_now", "_"), ("type", "recommend_type", "0"),
              ("eventLabel", "label", "_")]
CLICK_GENERAL = ["web_id", "uuid", "ga_id", "fb_id", "ip", "timestamp"]

# recommend_type base by click event name
CLICK_TYPE_BASE = {"keyword_side_hot": 0, "keyword_side_footprint": 1, "keyword_search": 2,
                   "keyword_word_hot": 3, "keyword_word_other": 4, "sliding_click": 5, "guess_click": 7,
                   "footprint_click": 8, "otherlike_click": 9, "onpage": 10}

PURCHASE_DROP = ["meta_title", "time_pageview", "scroll_depth", "scroll_depth_px", "click_count",
                 "time_no_move", "time_no_scroll", "time_no_click", "max_time_no_move", "max_time_no_scroll",
                 "max_time_no_scroll_array", "max_time_no_scroll_depth_array", "max_time_no_scroll_depth",
                 "max_time_no_scroll_depth_px", "max_time_no_click", "max_scroll_depth_page",
                 "time_pageview_total_last"]

SEND_COUPON_DROP = ["time_pageview", "scroll_depth", "scroll_depth_px", "click_count", "time_no_move",
                    "time_no_scroll", "time_no_click", "max_time_no_move", "max_time_no_scroll",
                    "max_time_no_scroll_array", "max_time_no_scroll_depth_array", "max_time_no_scroll_depth",
                    "max_time_no_scroll_depth_px", "max_time_no_click", "max_scroll_depth_page",
                    "time_pageview_total_last"]

UNIQUE_KEYS = {"load": ["date_time", "web_id", "uuid", "session_id"],
               "purchase": ["date_time", "web_id", "uuid", "product_id", "product_variant", "product_category",
                            "product_price", "product_name"],
               "addCart": ["date_time", "web_id", "uuid", "product_id"],
               "removeCart": ["date_time", "web_id", "uuid", "product_id"],
               "leave": ["date_time", "web_id", "uuid", "session_id"],
               "timeout": ["date_time", "web_id", "uuid", "session_id"]}
DEFAULT_UNIQUE = ["date_time", "web_id", "uuid", "session_id"]

LENGTH_LIMITS = {"web_id": 45, "uuid": 36, "ga_id": 45, "fb_id": 45, "timestamp": 16}

# repair of concatenated JSON objects: junk tags between / around documents
JUNK_TAGS = ['"landing"', '"]"']

PRODUCT_COLUMNS = ["product_id", "product_name", "product_price", "product_quantity", "product_category",
                   "product_category_name", "product_variant", "sku_id", "sku_name", "currency"]
PURCHASE_PRODUCT_COLUMNS = ["product_id", "product_name", "product_price", "product_quantity",
                            "product_category", "product_category_name", "product_variant", "coupon",
                            "currency", "order_id", "total_price", "shipping_price"]
# ---------------------------------------------------------------- end fixed


def unique_keys(event_type: str) -> list[str]:
    return UNIQUE_KEYS.get(event_type, DEFAULT_UNIQUE)

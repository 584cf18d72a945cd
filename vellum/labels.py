"""Word lists, labels, statuses and patterns that results must equal.

Everything here is plain data.  Rules that differ between runs (accepted types,
excluded keywords, hosts) are parameters of ``vellum.sources.config.RuleSet``.
"""

# --- fixed values: document types -------------------------------------------------
DOC_TYPE_PREFIXES = [
    "Văn bản hợp nhất",
    "Bộ luật",
    "Luật",
    "Nghị định",
    "Thông tư liên tịch",
    "Thông tư",
    "Nghị quyết",
    "Quyết định",
    "Chỉ thị",
    "Công văn",
]
PAGE_DOC_TYPES = [
    "Bộ luật",
    "Luật",
    "Nghị định",
    "Thông tư",
    "Nghị quyết",
    "Quyết định",
    "Chỉ thị",
    "Công văn",
]
TITLE_STARTS = ["luật", "nghị định", "thông tư", "bộ luật"]
DOC_TYPE_ID_TO_NAME = {"58": "Bộ luật", "10": "Luật", "11": "Nghị định", "21": "Thông tư"}
ACCEPTED_DOC_TYPES = ["Bộ luật", "Luật", "Nghị định", "Thông tư"]
SKIPPED_DOC_TYPES = ["Chỉ thị", "Quyết định", "Văn bản hợp nhất", "Công văn"]
CONFIRMED_DOC_TYPE_IDS = ["10", "11", "21", "58"]

# --- fixed values: listing pages --------------------------------------------------
DOCUMENT_URL_TAIL = r"-\d+-d\d+\.html(?:\?.*)?$"
EXCLUDED_URL_FRAGMENTS = [
    "van-ban-moi.html",
    "van-ban-phap-luat-moi.html",
    "danh-sach",
    "tim-kiem",
    "luat-su-tu-van",
    "tieu-chuan-viet-nam",
    "tieu-chuan-quoc-gia",
]
ROW_STOP_MARKERS = [
    "Tổng quan",
    "Nội dung",
    "VB gốc",
    "VB liên quan",
    "Hiệu lực",
    "Lược đồ",
    "Tiếng Anh",
    "Tải về",
    "Ban hành:",
    "Áp dụng:",
    "Cập nhật:",
    "Xác thực:",
]
NAVIGATION_TEXTS = [
    "Tổng quan",
    "Nội dung",
    "VB gốc",
    "VB liên quan",
    "Hiệu lực",
    "Lược đồ",
    "Tiếng Anh",
    "Tải về",
    "VB được hợp nhất",
    "Xem chi tiết",
    "Chi tiết",
    "In",
    "Lưu",
]
ROW_NAVIGATION_HINTS = ["Tổng quan", "VB liên quan", "Hiệu lực"]
FIELD_MARKER = "lĩnh vực"
LIST_START_MARKERS = ["Sắp xếp theo"]
LIST_END_MARKERS = ["DANH MỤC TRA CỨU", "TIN VĂN BẢN MỚI", "HỎI ĐÁP PHÁP LUẬT"]
PAGE_ERROR_MARKERS = ["404", "không tìm thấy", "not found", "trang không tồn tại"]
PAGE_UPDATING_MARKERS = ["dữ liệu đang cập nhật", "du lieu dang cap nhat"]
TOTAL_COUNT_PATTERNS = [
    r"Có\s+tất\s+cả\s+([\d\.,]+)\s+văn\s+bản",
    r"Tìm\s+thấy\s+([\d\.,]+)\s+văn\s+bản",
    r"([\d\.,]+)\s+văn\s+bản\s+mới",
]
REJECT_REASONS = [
    "required_url_path_contains",
    "doc_type",
    "exclude_title_keywords",
    "exclude_url_keywords",
    "exclude_so_hieu_keywords",
]
BLOCKED_URL_KEYWORDS = [
    "dat-dai",
    "hinh-su",
    "ke-hoach",
    "quyet-dinh",
    "cong-van",
    "chi-thi",
    "van-ban-hop-nhat",
    "vbhn",
]
HARD_BLOCKED_URL_KEYWORDS = ["chi-thi", "quyet-dinh", "van-ban-hop-nhat", "cong-van"]

# --- fixed values: document numbers -----------------------------------------------
NUMBER_PATTERN = r"(?:^|[^\p{L}0-9_])(\d{1,4}/\d{4}/\p{L}[\p{L}0-9.\-]*[\p{L}0-9])"
# Numbers in expiry clauses: any digits, slash or hyphen between the parts.
EXPIRY_NUMBER_PATTERN = r"(?:^|[^\p{L}0-9_])(\d+[/-]\d{4}[/-]\p{L}[\p{L}0-9.\-]*[\p{L}0-9])"
MARKED_NUMBER_PATTERN = (
    r"(?:^|[^\p{L}0-9_])[sS]ố\s+(\d{1,4}/\d{4}/\p{L}[\p{L}0-9.\-]*[\p{L}0-9])"
)
CIRCULAR_SUFFIX_VARIANTS = [
    "TT-BGDĐT",
    "TT-BGĐT",
    "TT-BGDDT",
    "TT-BGDT",
    "TT-GDĐT",
    "TT-GDDT",
    "TT-BGD",
]
CIRCULAR_SUFFIX = "TT-BGDĐT"
DATE_PATTERN = r"(?:^|[^0-9A-Za-z_])(\d{1,2}/\d{1,2}/\d{4})(?:[^0-9A-Za-z_]|$)"

# --- fixed values: relationship headings ------------------------------------------
DIAGRAM_HEADINGS = [
    "Văn bản căn cứ",
    "Văn bản được căn cứ",
    "Văn bản hướng dẫn",
    "Văn bản được hướng dẫn",
    "Văn bản sửa đổi, bổ sung",
    "Văn bản bị sửa đổi, bổ sung",
    "Văn bản thay thế",
    "Văn bản bị thay thế",
    "Văn bản hết hiệu lực",
    "Văn bản liên quan",
]
TRACKED_HEADINGS = [
    "Văn bản căn cứ",
    "Văn bản được hướng dẫn",
    "Văn bản hướng dẫn",
    "Văn bản hết hiệu lực",
    "Văn bản bị quy định hết hiệu lực",
    "Văn bản hết hiệu lực một phần",
    "Văn bản được hợp nhất",
    "Văn bản bị đình chỉ",
    "Văn bản bị đình chỉ một phần",
    "Văn bản được đính chính",
    "Văn bản thay thế",
    "Văn bản quy định hết hiệu lực",
    "Văn bản quy định hết hiệu lực một phần",
    "Văn bản hợp nhất",
    "Văn bản đình chỉ",
    "Văn bản đình chỉ một phần",
    "Văn bản đính chính",
    "Văn bản sửa đổi, bổ sung",
    "Văn bản bị sửa đổi, bổ sung",
]
# register mapping: heading -> official relationship column
OFFICIAL_COLUMN_BY_HEADING = {
    "Văn bản căn cứ": "basis",
    "Văn bản được hướng dẫn": "guided_by",
    "Văn bản bị sửa đổi, bổ sung": "amends",
    "Văn bản sửa đổi, bổ sung": "amended_by",
}
# extraction mapping, used before the register match overwrites it
EXTRACTED_COLUMN_BY_HEADING = {
    "Văn bản căn cứ": "basis",
    "Văn bản hướng dẫn": "guided_by",
    "Văn bản sửa đổi, bổ sung": "amends",
    "Văn bản bị sửa đổi, bổ sung": "amended_by",
}
HEADING_PREFIX = "văn bản"
HEADING_ALIASES = {
    "Văn bản căn cứ": ["văn bản căn cứ", "van ban can cu"],
    "Văn bản được hướng dẫn": ["văn bản được hướng dẫn", "van ban duoc huong dan"],
    "Văn bản hướng dẫn": [
        "văn bản hướng dẫn",
        "văn bản dẫn chiếu",
        "van ban huong dan",
        "van ban dan chieu",
    ],
    "Văn bản sửa đổi, bổ sung": [
        "văn bản sửa đổi, bổ sung",
        "văn bản sửa đổi bổ sung",
        "van ban sua doi bo sung",
    ],
    "Văn bản bị sửa đổi, bổ sung": [
        "văn bản bị sửa đổi, bổ sung",
        "văn bản bị sửa đổi bổ sung",
        "van ban bi sua doi bo sung",
    ],
}
NOISE_PHRASES = [
    "là văn bản ban hành trước",
    "là các văn bản ban hành trước",
    "được nêu trong nội dung của",
    "bị sửa đổi, bổ sung là văn bản",
]
RELATION_STATUSES = [
    "Chưa quét",
    "Đã gợi ý",
    "Cần kiểm tra thủ công",
    "Cần xác nhận",
    "Lỗi quét",
]
NOT_SCANNED, SUGGESTED = "Chưa quét", "Đã gợi ý"
NOTE_COMPARE_LINE = (
    "Trạng thái đối chiếu: Chưa đối chiếu ID nội bộ (chỉ gợi ý theo số hiệu/nội dung)."
)

# --- fixed values: register columns (internal name -> sheet label) ------------------
SHEET_LABELS = {
    "id": "ID VĂN BẢN",
    "field": "Lĩnh vực",
    "topic": "Chủ đề",
    "section": "Mục",
    "doc_type": "Loại văn bản",
    "title": "Tên văn bản",
    "number": "Số hiệu",
    "effective_date": "Ngày hiệu lực",
    "impact": "Mức độ tác động",
    "department": "Bộ phận chủ trì",
    "url": "Link Văn bản",
    "basis": "Căn cứ pháp lý",
    "guided_by": "Hướng dẫn thực hiện",
    "amends": "Sửa đổi, bổ sung cho",
    "amended_by": "Sửa đổi, bổ sung bởi",
    "approval_status": "Trạng thái duyệt",
    "process_status": "Trạng thái xử lý",
    "basis_text": "Nội dung căn cứ",
    "basis_hint": "Gợi ý căn cứ pháp lý",
    "not_in_register": "Văn bản chưa có trong danh mục",
    "relation_status": "Trạng thái quan hệ pháp lý",
    "relation_note": "Ghi chú quan hệ pháp lý",
    "source": "Nguồn dữ liệu",
    "scanned_at": "Ngày Python quét",
    "scan_note": "Ghi chú Python",
}
REQUIRED_COLUMNS = [
    "id", "doc_type", "title", "number", "effective_date", "url",
    "approval_status", "process_status",
]
PROTECTED_COLUMNS = [
    "id", "field", "topic", "section", "impact", "department", "approval_status",
]
TRANSFER_REQUIRED = ["field", "impact", "doc_type", "title", "number", "url", "department"]
OFFICIAL_COLUMNS = ["basis", "guided_by", "amends", "amended_by"]
CLEANED_ON_EXPIRY = [
    "basis", "guided_by", "amends", "amended_by",
    "basis_text", "basis_hint", "not_in_register", "relation_note",
]

# --- fixed values: register statuses ----------------------------------------------
TRANSFERRED = "Đã chuyển"
IRRELEVANT = "Không liên quan"
CHECKED = "Đã kiểm tra"
MANUAL_CHECK = "Cần kiểm tra thủ công"
DUPLICATE_NUMBER = "Trùng số hiệu"
WAITING_CHECK = "Chờ kiểm tra"
WAITING_AUTO_CHECK = "Chờ kiểm tra tự động"
TRANSFERRED_TEXT, CHECKED_TEXT = "đã chuyển", "đã kiểm tra"
RETENTION_DAYS = 90
LOG_ROWS_KEPT = 5000
LOG_TEXT_MAX = 20000
LOG_TRIM_MARKER = "\n...<trimmed_to_prevent_error>"
WRITE_GATE_KEYWORDS = [
    "van-ban-hop-nhat", "văn bản hợp nhất", "vbhn", "chi-thi", "chỉ thị",
    "quyet-dinh", "quyết định", "cong-van", "công văn",
]
SENSITIVE_KEYS = [
    "password", "token", "secret", "session", "cookie", "cookies", "authorization",
    "signature", "access_token", "refresh_token", "client_secret", "device_code",
    "user_code", "admin_session", "adminsessiontoken",
]
REDACTED = "[REDACTED]"
PATH_KEYS = {
    "/sync-webapp-to-planner": [
        "source", "source_row_number", "vbqppl_row_number", "so_hieu", "limit", "dry_run",
    ],
    "/delete-planner-task": ["planner_task_id", "task_id", "so_hieu", "ten_van_ban"],
}

# --- fixed values: submissions ----------------------------------------------------
RETRY_CODES = [408, 409, 425, 429, 500, 502, 503, 504]
RETRY_MARKERS = [
    "timed out", "timeout", "connection reset", "connection aborted",
    "connection refused", "forcibly closed", "remote end closed",
    "temporarily unavailable", "too many requests", "service unavailable",
    "bad gateway", "gateway timeout",
]

# --- fixed values: tasks ----------------------------------------------------------
TASK_CREATED = "Đã tạo task Planner"
TASK_DELETED = "Đã xóa task Planner"
TASK_DONE = "Đã hoàn thành task"
CHECKPOINT_DONE = "Đã hoàn thành checkpoint"
TASK_WAITING = "Đang chờ PIC xử lý"
ALL_DONE_TEXT = "Đã hoàn thành toàn bộ"
DONE_PREFIX = "Đã hoàn thành: "
FIRST_STEP = "Phân tích sơ bộ"
FIRST_BUCKET = "Pháp chế"
DUE_LABEL = "Hạn hoàn thành"
OLD_DUE_LABEL = "DueDay"
REPORT_COMPLETED = [CHECKPOINT_DONE, TASK_DONE]
ALERT_COMPLETED = [TASK_DELETED, CHECKPOINT_DONE, TASK_DONE]
BLANK_STATUS = "(trống)"
MAX_TASK_TITLE, MAX_CHECKLIST_TITLE, MAX_ALIAS = 255, 100, 100
REFERENCE_KEY_ESCAPES = [("%", "%25"), (".", "%2E"), (":", "%3A"), ("@", "%40"), ("#", "%23")]
LOCAL_ZONE = "Asia/Ho_Chi_Minh"
DUE_HOUR = 17
ALERT_CRITICAL_DAYS, ALERT_WARNING_DAYS = 7, 3
ALERT_STYLES = {
    "critical": ("🔴", "#ffebee", "#b71c1c"),
    "warning": ("🟡", "#fff8e1", "#e65100"),
    "info": ("🔵", "#f1f8e9", "#2e7d32"),
}
STATE_DATES_KEPT = 30
REPORT_COLUMNS = {
    "overdue_tasks": [
        ("number", "Số hiệu"), ("title", "Tên văn bản"), ("task_id", "Planner Task ID"),
        ("task_url", "Planner Task URL"), ("sync_status", "Planner Sync Status"),
        ("last_sync", "Planner Last Sync"), ("pic", "Current PIC"),
        ("checkpoint", "Current Checkpoint"), ("next_due", "Next Response Due"),
        ("department", "Bộ phận"), ("due_text", "Ngày hạn"),
        ("days_overdue", "Số ngày quá hạn"),
    ],
    "slow_departments": [
        ("department", "Bộ phận"), ("total", "Tổng việc"), ("overdue", "Việc quá hạn"),
        ("overdue_percent", "Tỷ lệ quá hạn (%)"),
    ],
    "slow_people": [
        ("pic", "Current PIC"), ("total", "Tổng việc"), ("overdue", "Việc quá hạn"),
        ("overdue_percent", "Tỷ lệ quá hạn (%)"),
    ],
    "checklist_completion": [
        ("total", "Tổng task"), ("completed", "Đã hoàn thành"),
        ("completion_percent", "Tỷ lệ hoàn thành (%)"),
    ],
}

# --- fixed values: expiry ---------------------------------------------------------
EXPIRY_STRONG = [
    "hết hiệu lực", "bị bãi bỏ", "được thay thế bởi", "thay thế",
    "chấm dứt hiệu lực", "không còn hiệu lực",
]
EXPIRY_PARTIAL = [
    "một phần", "hết hiệu lực một phần", "bãi bỏ một phần", "thay thế một phần",
]
EXPIRY_SECTIONS = ["điều khoản thi hành", "hiệu lực thi hành", "điều khoản chuyển tiếp"]
EXPIRY_BLOCK_END = r"(?:Điều \d+|CHƯƠNG|[A-Z]{5,}|\z)"
EXPIRY_MANUAL = "Cần kiểm tra thủ công"
EXPIRY_NO_DATE = "Cần kiểm tra thủ công (Không rõ ngày)"
EXPIRY_FUTURE = "Chưa xóa - chưa đến ngày hết hiệu lực"
EXPIRY_WAITING = "Chờ xóa tự động"
EXPIRY_FETCH_FAILED = "Thất bại - Cần check tay"
EXPIRY_FETCH_REASON = "Lỗi tải link"
EXPIRY_SIMULATED = "Đã mô phỏng xóa (DRY_RUN)"
EXPIRY_DELETED = "Đã xóa theo lịch"
EXPIRY_NOTE = "Hệ thống tự động quét từ nội dung văn bản mới"
EXPIRY_YES, EXPIRY_NO = "CÓ", "KHÔNG"

# --- fixed values: lines of the run report and of the readable listing ----------------
REPORT_RULE, LISTING_RULE = "=" * 100, "=" * 80
REPORT_DASHES, LISTING_DASHES = "-" * 100, "-" * 80
REPORT_OK, REPORT_NOT_OK = "ĐẠT", "CHƯA ĐẠT"
REPORT_TEXTS = {
    "created": "Thời gian tạo báo cáo: ",
    "verdict": "Kết luận: ",
    "config": "CẤU HÌNH",
    "config_errors": "Lỗi cấu hình:",
    "config_none": "Không phát hiện lỗi cấu hình nghiêm trọng.",
    "config_warnings": "Cảnh báo cấu hình:",
    "production": "CHỈ SỐ PRODUCTION",
    "by_heading": "Match coverage theo nhóm quan hệ:",
    "delta": "Missing delta so với lần chạy trước:",
    "new_missing": "Missing mới phát sinh:",
    "top_missing": "Top missing refs cần ưu tiên bổ sung VBQPPL:",
    "conclusion": "KẾT LUẬN",
    "errors": "Lỗi cần xử lý:",
    "no_errors": "Không có lỗi nghiêm trọng.",
    "warnings": "Cảnh báo:",
}
REPORT_DELTA = [
    ("current_missing", "- Missing hiện tại: ", " số hiệu unique"),
    ("previous_missing", "- Missing lần trước: ", " số hiệu unique"),
    ("new_missing", "- Missing mới: ", ""),
    ("resolved_missing", "- Missing đã được xử lý: ", ""),
    ("persistent_missing", "- Missing còn tồn tại: ", ""),
    ("net_delta", "- Net delta: ", ""),
]
#: Lists of the run report: name, heading, lines of an item as (label, column).
REPORT_LISTS = [
    ("invalid", "STEP07", "STEP07 - Document không đạt filter:",
     [("- ", "title"), ("  Loại: ", "doc_type"), ("  Số hiệu: ", "doc_number"), ("  URL: ", "url"), ("  Lỗi: ", "problems")]),
    ("warning", "STEP07", "STEP07 - Document cảnh báo:", [("- ", "title"), ("  URL: ", "url"), ("  Cảnh báo: ", "problems")]),
    ("payload_invalid", "STEP08", "STEP08 - Payload không hợp lệ:",
     [("- ", "name"), ("  Loại: ", "doc_type"), ("  URL: ", "url"), ("  Lỗi: ", "problems")]),
    ("result_error", "STEP08", "STEP08 - Result lỗi:",
     [("- URL: ", "url"), ("  Status: ", "status"), ("  Message: ", "message"), ("  Error: ", "error"), ("  Response: ", "response")]),
    ("no_match_report", "STEP08", "STEP08 - Sent nhưng thiếu match_report:", [("- URL: ", "url"), ("  Response: ", "response")]),
    ("relation_missing", "STEP08", "STEP08 - Quan hệ pháp lý chưa có trong danh mục:",
     [("- URL: ", "url"), ("  Missing relationships: ", "missing_relations")]),
]
LISTING_TEXTS = {
    "run": [("created_at", "Thời gian chạy: "), ("run_mode", "Run mode: "), ("fields", "Tổng số lĩnh vực đã xử lý: "), ("documents", "Tổng số URL văn bản: ")],
    "field": [
        ("field_name", "Lĩnh vực: "), ("field_code", "Mã lĩnh vực: "), ("status", "Trạng thái: "), ("announced", "Số văn bản công bố trên trang đầu: "),
        ("page_count", "Số trang đã crawl: "), ("document_count", "Số URL văn bản thu được: "),
    ],
    "pages": "CHI TIẾT THEO TRANG",
    "documents": "DANH SÁCH URL",
    "untitled": "(không có tiêu đề)",
    "document": [("doc_type", "   Loại nhận diện: "), ("doc_number", "   Số hiệu nhận diện: "), ("page_index", "   Trang nguồn: "), ("url", "   URL: ")],
}
